"""The operators as queries over whole tables, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketflow.llm import (
    bpe,
    chats,
    exact,
    extract,
    language,
    licences,
    near,
    packing,
    quality,
    spelling,
    substrings,
    turn_trie,
    warc,
)
from marketflow.llm.labelled_pages import labelled_pages

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query()
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    forest = quality.fit(docs, table(spark, sf_dir, "labels"))
    judged = quality.judge(docs, forest)
    return judged.select("doc_id", *quality.COUNTS, "base_failed", "anomaly", "kept")


@_query()
def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.linked(table(spark, sf_dir, "documents")).drop("mark", "digest")


@_query()
def op3_cutting_stock_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


@_query()
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return bpe.decode(encoded, ranks).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@_query()
def op5_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.main_text(table(spark, sf_dir, "pages"), extract.train(labelled_pages()))


@_query()
def op6_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.round_trip(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@_query()
def op7_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan(table(spark, sf_dir, "documents"))
    names = F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["licence"])))
    return found.select(
        "doc_id", "n_blocks", F.size("hits").cast("long").alias("n_hits"), F.array_join(names, ",").alias("licences"),
        F.array_join(F.transform("hits", lambda h: F.concat_ws(":", h["line"].cast("string"), h["licence"])), ",").alias("places"),
    )


_BLANKS = r"[\x20\x09-\x0D]"


@_query(rf"""
    WITH d AS (
        SELECT doc_id, coalesce(length(text), 0) AS n, sha256(regexp_replace(coalesce(text, ''), '{_BLANKS}', '', 'g')) AS h
        FROM documents),
    g AS (
        SELECT doc_id, h, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY h) AS group_size
        FROM d WINDOW w AS (PARTITION BY h ORDER BY n DESC, doc_id))
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, h AS text_sha256 FROM g
    """)
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.duplicates(table(spark, sf_dir, "documents"))


@_query(r"""
    WITH d AS (
        SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    win AS (
        SELECT doc_id, s, array_to_string(w[s : s + 49], ' ') AS k
        FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 49)) AS s FROM d)),
    firsts AS (SELECT k, min(doc_id) AS f FROM win GROUP BY k),
    gone AS (
        SELECT DISTINCT doc_id, unnest(generate_series(s, s + 49)) AS p
        FROM win JOIN firsts USING (k) WHERE f < doc_id),
    gone_lists AS (SELECT doc_id, list(p) AS ps, count(*) AS n_removed FROM gone GROUP BY doc_id),
    kept AS (
        SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed,
            CASE WHEN ps IS NULL THEN w
                 ELSE list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda x: NOT list_contains(ps, x[2])), lambda x: x[1])
            END AS kw
        FROM d LEFT JOIN gone_lists USING (doc_id))
    SELECT doc_id, n_words, n_removed, sha256(array_to_string(kw, ' ')) AS kept_sha256 FROM kept
    """)
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.removals(table(spark, sf_dir, "documents"))


@_query()
def op9_reply_ordered_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chats.reply_ordered(table(spark, sf_dir, "conversations"))


def _crc32(data: str) -> str:
    """DuckDB SQL for the unsigned CRC-32 of a list of byte values, as a bigint."""
    step = "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    # The register is shifted by eight bits for each byte; the byte goes into its low bits first.
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {data}), lambda a, b: {step}), 4294967295)"


@_query(rf"""
    WITH t AS (
        SELECT conv_id, turn, coalesce(strlen(text), 0) AS size,
            left(sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 32) AS code
        FROM conversations WHERE conv_id IS NOT NULL),
    own AS (
        SELECT conv_id, list(code ORDER BY turn NULLS FIRST, code) AS codes, list(size ORDER BY turn NULLS FIRST, code) AS sizes
        FROM t GROUP BY conv_id),
    lent AS (
        SELECT conv_id, codes, sizes, conv_id - ((conv_id % 5) + 5) % 5 AS base,
            {_crc32("list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ord(s)::BIGINT)")} % 9 AS h
        FROM own),
    built AS (
        SELECT l.conv_id, list_concat(coalesce(b.codes, [])[1:h], l.codes[h + 1:]) AS codes,
            list_concat(coalesce(b.sizes, [])[1:h], l.sizes[h + 1:]) AS sizes
        FROM lent l LEFT JOIN own b ON b.conv_id = l.base),
    p AS (SELECT conv_id, codes, sizes, unnest(range(0, len(codes) + 1)) AS d FROM built),
    n AS (
        SELECT array_to_string(codes[1:d], '') AS k, d, min(conv_id) AS conv_id, count(*) AS n_convs,
            any_value(array_to_string(codes[1:d - 1], '')) AS pk, coalesce(any_value(sizes[d]), 0) AS size,
            coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(codes) = d), '') AS ends
        FROM p GROUP BY 1, 2),
    kids AS (SELECT pk AS k, count(*) AS c FROM n WHERE d > 0 GROUP BY pk),
    own_sums AS (
        SELECT n.k, n.d, (c IS NULL)::BIGINT AS leaf, (n_convs - 1) * size AS saved FROM n LEFT JOIN kids USING (k)),
    up AS (SELECT leaf, saved, left(k, (32 * unnest(range(0, d + 1)))::INT) AS k FROM own_sums),
    sums AS (SELECT k, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens FROM up GROUP BY k)
    SELECT n.conv_id, n.d AS depth, CASE WHEN n.d > 0 THEN par.conv_id END AS parent_conv_id, n.n_convs,
        coalesce(c, 0) AS n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, sha256(n.ends) AS ends_sha256
    FROM n JOIN sums USING (k) LEFT JOIN kids USING (k) LEFT JOIN n par ON par.k = n.pk AND par.d = n.d - 1
    """)
def op11_turn_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_trie.nodes(table(spark, sf_dir, "conversations"))


@_query(rf"""
    WITH runs AS (
        SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents),
    per AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL),
    bytes AS (
        SELECT run, n, list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''), lambda s: ord(s)) AS points FROM per),
    coded AS (
        SELECT run, n, {_crc32("flatten(list_transform(points, lambda u: CASE WHEN u < 128 THEN [u::BIGINT] ELSE [(192 + (u >> 6))::BIGINT, (128 + (u & 63))::BIGINT] END))")} AS h
        FROM bytes),
    words AS (
        SELECT CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM coded),
    w AS (SELECT word, sum(n)::BIGINT AS n FROM words WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
    holes AS (
        SELECT word, n, i, left(word, i::INT) || substr(word, i::INT + 2) AS rest
        FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM w)),
    longer AS (SELECT DISTINCT h.word AS a, w.word AS b FROM holes h JOIN w ON w.word = h.rest),
    near AS (
        SELECT x.word AS a, y.word AS b FROM holes x JOIN holes y ON x.rest = y.rest AND x.i = y.i AND x.word <> y.word
        UNION SELECT a, b FROM longer UNION SELECT b, a FROM longer),
    ranked AS (
        SELECT a AS word, count(*) AS n_near, arg_min(b, (-w.n, encode(b))) AS best, max(w.n) AS best_n
        FROM near JOIN w ON w.word = near.b GROUP BY a),
    forms AS (
        SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
            CASE WHEN best_n >= 2 * w.n THEN best END AS form, CASE WHEN best_n >= 2 * w.n THEN best_n END AS form_n
        FROM w LEFT JOIN ranked r ON r.word = w.word),
    chain AS (
        WITH RECURSIVE c(word, place) AS (
            SELECT word, word FROM forms UNION ALL SELECT c.word, f.form FROM c JOIN forms f ON f.word = c.place WHERE f.form IS NOT NULL)
        SELECT c.word, c.place AS root FROM c JOIN forms f ON f.word = c.place WHERE f.form IS NULL)
    SELECT word, form, root, n, n_near, form_n FROM forms JOIN chain USING (word)
    """)
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


@_query()
def op13_language_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    codes = language.fit(docs, ~language.held_out())
    return language.predict(docs, codes).select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score", "ambiguous")

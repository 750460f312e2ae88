"""Chats in reply order without quotations, by DataFrame functions only.

Lines that begin with ``>`` are quoted, as deep as there are signs. A passage is a run of lines of one
depth. The whole passage, its paragraphs, its lines and its sentences are normalised (lower case, single spaces) and
hashed, as are the own words of the messages of conversations that quote; so are the runs of up to five, and of 10, 20
and 40 words of both, over line ends and without punctuation around words, since a quotation may begin and end anywhere in a line and be
wrapped anew. Of a passage, these runs count from five words on, and whole lines, sentences and passages that are shorter. The
latest earlier messages of the conversation that hold a unit are compared by the characters of the passage that
all their units cover, then by those in whole lines, sentences and paragraphs; the passage is linked with the best, of
equal ones the latest. A message replies to the original of its outermost linked passage; replies follow the message that began their
thread. Lines that only say who wrote what follows are part of the quotation.

Turns are dealt into ranges wherever messages of one conversation are ordered, so that no conversation is
sorted in one task.

Defined cases: a null text is empty; null conversations form one conversation, null turns come last; rows
that repeat conversation and turn all stay, ordered by role and text; a quotation nobody wrote is removed and
links nothing; an empty table gives an empty result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketflow.session import broadcast_if_small, stage

# Turns of one range.
RANGE = 1024
# Words of a run that links.
RUN = 5
# Longer runs find an original whose parts several later messages repeat.
LONGER = (10, 20, 40)
_LAST = (1 << 63) - 1
_QUOTE = r"^[ \t]*(?:>[ \t]*)+"
_SENTENCE = r"(?<=[.!?\u2026])\s+"
_AROUND = r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$"
_COVERS = "array<struct<place:bigint,chars:bigint>>"
_UNITS = f"array<struct<unit:string,size:bigint,covers:{_COVERS}>>"
_SAYS = r"(?i)\b(wrote|writes|schrieb|écrit|escribió)\s*:\s*$"


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def _units(text: Column) -> Column:
    """Hashes of the whole, the paragraphs, the lines and the sentences of a text, each with its size."""
    parts = F.concat(F.array(text), F.split(text, r"\n[ \t]*\n"), F.split(text, "\n"), F.split(text, _SENTENCE))
    kept = F.filter(F.array_distinct(F.transform(parts, normalised)), lambda u: F.length(u) > 0)
    return F.transform(kept, lambda u: F.struct(F.sha2(u, 256).alias("unit"), F.length(u).cast("long").alias("size"), F.array().cast(_COVERS).alias("covers")))


def _words(text: Column) -> Column:
    """Words without the punctuation around them; what is only punctuation stays."""
    bare = F.transform(F.split(normalised(text), " "), lambda w: F.coalesce(F.nullif(F.regexp_replace(w, _AROUND, ""), F.lit("")), w))
    return F.filter(bare, lambda w: F.length(w) > 0)


def _runs(words: Column, size: Column, before: Column) -> Column:
    """Hashes of all runs of ``size`` words, each with the places (``before`` words precede) and lengths of its words."""

    def run(k: Column) -> Column:
        held = F.slice(words, k, size)
        covers = F.transform(held, lambda w, i: F.struct((before + k + i).cast("long").alias("place"), F.length(w).cast("long").alias("chars")))
        unit = F.sha2(F.concat(F.lit("run "), F.array_join(held, " ")), 256)
        return F.struct(unit.alias("unit"), F.lit(0).cast("long").alias("size"), covers.alias("covers"))

    starts = F.sequence(F.lit(1), F.size(words) - size + 1)
    return F.when((size > 0) & (F.size(words) >= size), F.transform(starts, run)).otherwise(F.array().cast(_UNITS))


def _short_runs(parts: Column) -> Column:
    """For the words of the parts of a text, the runs that are a whole part of fewer than RUN words."""

    def run(words: Column, k: Column) -> Column:
        before = F.aggregate(F.slice(parts, 1, k), F.lit(0), lambda n, p: n + F.size(p))
        return F.when(F.size(words) < RUN, _runs(words, F.size(words), before)).otherwise(F.array().cast(_UNITS))

    return F.transform(parts, run)


def _with_words(texts: DataFrame, text: str) -> DataFrame:
    """``words`` of the text and of its lines and sentences, as columns, so that they are split once."""
    parts = {"line_words": F.split(text, "\n"), "sentence_words": F.split(text, _SENTENCE)}
    return texts.withColumn("words", _words(F.col(text))).withColumns({n: F.transform(p, _words) for n, p in parts.items()})


def _quoted_runs() -> Column:
    """Runs of RUN words and of the LONGER sizes, and the shorter lines and sentences (and the passage itself if it is shorter)."""
    words = F.col("words")
    runs = [_runs(words, F.least(F.lit(RUN), F.size(words)), F.lit(0)), *(_runs(words, F.lit(n), F.lit(0)) for n in LONGER)]
    short = [F.flatten(_short_runs(F.col(parts))) for parts in ("line_words", "sentence_words")]
    return F.concat(*runs, *short)


def _own_runs() -> Column:
    words = F.col("words")
    return F.concat(*[F.transform(_runs(words, F.lit(n), F.lit(0)), lambda u: u["unit"]) for n in (*range(1, RUN + 1), *LONGER)])


def _joined(order: str, line: str) -> Column:
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, line))), lambda p: p[line]), "\n")


def _lines(messages: DataFrame) -> DataFrame:
    """Lines of messages that quote: depth, words without the signs, run number, and whether a line only introduces a quotation."""
    quoting = messages.where(F.col("text").rlike(r"(?m)^[ \t]*>"))
    lines = quoting.select("row", "conv", "at", F.posexplode(F.split("text", "\n")).alias("n", "line"))
    prefix = F.regexp_extract("line", _QUOTE, 0)
    lines = lines.withColumn("depth", F.length(F.regexp_replace(prefix, "[^>]", "")))
    lines = lines.withColumn("body", F.regexp_replace("line", _QUOTE, ""))
    order = Window.partitionBy("row").orderBy("n")
    follows = F.coalesce(F.lead("depth").over(order), F.lit(0))
    lines = lines.withColumn("says", (F.col("depth") == 0) & (follows > 0) & F.col("line").rlike(_SAYS))
    new = F.when(F.col("depth") == F.lag("depth").over(order), 0).otherwise(1)
    return lines.withColumn("new", new).withColumn("run", F.sum("new").over(order)).drop("new", "line")


def _latest_before(events: DataFrame) -> DataFrame:
    """For events (conv, unit, at, ...), ``said`` at the latest earlier event with one; ordered range by range."""
    dealt = events.withColumn("range", F.floor(F.col("at") / RANGE))
    per_range = dealt.groupBy("conv", "unit", "range").agg(F.max("said").alias("within"))
    earlier = Window.partitionBy("conv", "unit").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_range.select("conv", "unit", "range", F.max("within").over(earlier).alias("carried"))
    inside = Window.partitionBy("conv", "unit", "range").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    found = dealt.withColumn("inside", F.max("said").over(inside)).join(carried, ["conv", "unit", "range"])
    return found.withColumn("original", F.coalesce("inside", "carried")).drop("range", "inside", "carried")


def _links(messages: DataFrame, passages: DataFrame) -> DataFrame:
    """Per passage with an original: row, run, depth, conv, at and the original's turn."""
    quoting = broadcast_if_small(passages.select("conv").distinct())
    units = F.concat(_units(F.col("passage")), _quoted_runs())
    quoted = _with_words(passages, "passage").select("conv", "at", "row", "run", "depth", F.explode(units).alias("u"))
    quoted = stage(quoted.select("conv", "at", "row", "run", "depth", "u.unit", "u.size", "u.covers"), "quoted")
    texts = messages.join(quoting, "conv", "left_semi").withColumn("words", _words(F.col("clean")))
    units = F.concat(F.transform(_units(F.col("clean")), lambda u: u["unit"]), _own_runs())
    own = texts.select("conv", "at", F.explode(units).alias("unit"))
    # Only units that are quoted are ordered.
    own = stage(own.join(quoted.select("conv", "unit").distinct(), ["conv", "unit"], "left_semi").distinct(), "own")
    events = quoted.drop("size", "covers").withColumn("said", F.lit(None).cast("long"))
    events = events.unionByName(own.withColumn("said", F.col("at")), allowMissingColumns=True)
    found = _latest_before(events).where("said is null and original is not null")
    key = ["row", "run", "depth", "conv", "at"]
    possible = found.select(*key, "original").distinct()
    # What each possible original holds of the passage, other messages aside.
    held = quoted.join(possible, key).join(own.select("conv", F.col("at").alias("original"), "unit"), ["conv", "original", "unit"], "left_semi")
    held = stage(held.select(*key, "original", "size", "covers"), "held")
    whole = held.groupBy(*key, "original").agg(F.sum("size").alias("whole"))
    # Runs overlap; every word counts once. Counted in rows, as sets of pairs in one cell take the square of their number.
    words = held.select(*key, "original", F.explode("covers").alias("w")).select(*key, "original", "w.place", "w.chars")
    words = words.groupBy(*key, "original", "place").agg(F.max("chars").alias("chars"))
    covered = words.groupBy(*key, "original").agg(F.sum("chars").alias("covered"))
    scores = whole.join(covered, [*key, "original"], "left").withColumn("covered", F.coalesce("covered", F.lit(0).cast("long")))
    best = scores.groupBy(*key).agg(F.max(F.struct("covered", "whole", "original")).alias("best"))
    return best.select(*key, F.col("best.original").alias("original"))


def _threads(replies: DataFrame) -> DataFrame:
    """(conv, at, thread): the turn that began the thread of every reply, by doubling the steps upward."""
    up = stage(replies.groupBy("conv", "at").agg(F.min("original").alias("thread")), "threads")
    while True:
        above = up.select("conv", F.col("at").alias("thread"), F.col("thread").alias("higher"))
        moved = stage(up.join(above, ["conv", "thread"], "left").select("conv", "at", F.coalesce("higher", "thread").alias("thread"), "higher"), "threads")
        if moved.where("higher is not null").isEmpty():
            return moved.drop("higher")
        up = moved.drop("higher")


def _positions(rows: DataFrame) -> DataFrame:
    """``position`` of every row within its conversation by (thread, at, role, message), counted range by range."""
    dealt = rows.withColumn("outer", F.floor(F.col("thread") / RANGE)).withColumn("inner", F.floor(F.col("at") / RANGE))
    inner = dealt.groupBy("conv", "outer", "thread", "inner").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("conv", "outer").orderBy("thread", "inner").rowsBetween(Window.unboundedPreceding, -1)
    inner = inner.withColumn("skip", F.coalesce(F.sum("rows").over(before), F.lit(0)))
    outer = inner.groupBy("conv", "outer").agg(F.sum("rows").alias("rows"))
    before = Window.partitionBy("conv").orderBy("outer").rowsBetween(Window.unboundedPreceding, -1)
    outer = outer.select("conv", "outer", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("skip_outer"))
    place = F.row_number().over(Window.partitionBy("conv", "outer", "thread", "inner").orderBy("at", "role", "message", "row"))
    joined = dealt.withColumn("place", place).join(inner.drop("rows"), ["conv", "outer", "thread", "inner"]).join(outer, ["conv", "outer"])
    return joined.withColumn("position", F.col("skip_outer") + F.col("skip") + F.col("place") - 1)


def reply_ordered(conversations: DataFrame) -> DataFrame:
    """One row per message: conv_id, turn, role, reply_to, thread, position (from 0), n_quotes, n_linked, message."""
    rows = conversations.select(
        F.col("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    # The sign keeps null apart from a conversation that is called so.
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("none"))
    rows = rows.withColumn("conv", conv).withColumn("at", F.coalesce("turn", F.lit(_LAST)))
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "messages")
    lines = stage(_lines(rows), "lines")
    own = lines.where("depth = 0 and not says").groupBy("row").agg(_joined("n", "body").alias("own"))
    passages = lines.where("depth > 0").groupBy("row", "conv", "at", "run", "depth").agg(_joined("n", "body").alias("passage"))
    passages = stage(passages, "passages")
    quotes = passages.groupBy("row").agg(F.count(F.lit(1)).alias("n_quotes"))
    parts = rows.join(broadcast_if_small(quotes), "row", "left").join(own, "row", "left")
    bare = F.regexp_replace(F.regexp_replace(F.coalesce("own", F.lit("")), r"^\s+", ""), r"\s+$", "")
    messages = parts.withColumn("clean", F.when(F.col("n_quotes").isNull(), F.col("text")).otherwise(bare))
    links = stage(_links(messages, passages), "links")
    reply = links.groupBy("row", "conv", "at").agg(
        F.min(F.struct("depth", "run", "original")).alias("first"), F.count(F.lit(1)).alias("n_linked")
    ).select("row", "conv", "at", F.col("first.original").alias("original"), "n_linked")
    threads = _threads(reply)
    told = reply.join(threads, ["conv", "at"]).select("row", "original", "n_linked", "thread")
    told = broadcast_if_small(stage(told, "replies"))
    joined = messages.join(told, "row", "left").select(
        "conv_id", "turn", "role", "conv", "at", "row",
        F.when(F.col("original") < _LAST, F.col("original")).alias("reply_to"), F.coalesce("thread", "at").alias("thread"),
        F.coalesce("n_quotes", F.lit(0).cast("long")).alias("n_quotes"), F.coalesce("n_linked", F.lit(0).cast("long")).alias("n_linked"),
        F.col("clean").alias("message"),
    )
    placed = _positions(stage(joined, "placed"))
    thread = F.when(F.col("thread") < _LAST, F.col("thread")).alias("thread")
    return placed.select("conv_id", "turn", "role", "reply_to", thread, F.col("position").cast("long").alias("position"), "n_quotes", "n_linked", "message")

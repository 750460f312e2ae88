"""JSON and XML report documents to rows.

A document is one text value: a whole file, or one line of a file of documents.
Rows of a document are exploded right after parsing, so the unit of parallel work
is the document; large deliveries should come as many documents.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketflow.functions import names
from marketflow.operators.nested import xml_row
from marketflow.operators.shapes import flatten_unknown
from marketflow.session import broadcast_if_small, stage
from marketflow.sources.lines import Paths

# Row element names, in the order they are looked for, and the
# record paths of the report types that have a named one.
ROW_TAGS = ("Node", "Record", "Row", "Item")
SEARCH_RECORDS = "dataByAsin"
TRAFFIC_RECORDS = "salesAndTrafficByDate"


def read_documents(spark: SparkSession, paths: Paths, per_line: bool = False) -> DataFrame:
    """Documents as ``path`` and ``document``; compressed files are unpacked."""
    text = spark.read.text(paths, wholetext=not per_line)
    return text.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("document"))


def named_records(documents: DataFrame, path: str, schema: T.StructType) -> DataFrame:
    """Rows of the list under ``path``; a missing or empty list gives no rows."""
    wrapper = T.StructType([T.StructField(path, T.ArrayType(schema))])
    records = F.from_json("document", wrapper)[path]
    return documents.select(F.inline(records))


def _member_lists(documents: DataFrame) -> DataFrame:
    """Per document the text of the list of its rows, as ``rows``."""
    texts = documents.select(F.trim("document", F.lit(" \t\r\n\ufeff")).alias("text"))
    text = F.col("text")
    members = F.when(text.startswith("{"), F.map_entries(F.from_json(text, "map<string,variant>")))
    lists = F.filter(members, lambda m: F.schema_of_variant(m["value"]).startswith("ARRAY"))
    first = texts.select("text", F.get(lists, F.lit(0))["value"].alias("first_list"))
    rows = (
        F.when(text.startswith("["), text)
        .when(F.col("first_list").isNotNull(), F.to_json("first_list"))
        .when(text.startswith("{"), F.concat(F.lit("["), text, F.lit("]")))
    )
    return first.select(rows.alias("rows"))


def generic_records(documents: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of documents of unknown shape.

    A list gives its members; an object the members of its first list, in document
    order; an object without lists itself. Members are read by ``schema``.
    """
    return _member_lists(documents).select(F.inline(F.from_json("rows", T.ArrayType(schema))))


def discovered_records(documents: DataFrame) -> DataFrame:
    """The rows of :func:`generic_records` without a schema: their members are found and flattened."""
    members = _member_lists(documents).select(F.explode(F.from_json("rows", "array<variant>")).alias("record"))
    return flatten_unknown(members, ["record"])


def scalar_documents(documents: DataFrame) -> DataFrame:
    """Documents that are neither list nor object: one row with the value as text."""
    value = F.try_parse_json("document")
    kind = F.schema_of_variant(value)
    plain = value.isNotNull() & ~kind.startswith("ARRAY") & ~kind.startswith("OBJECT")
    return documents.where(plain).select(F.try_variant_get(value, "$", "string").alias("value"))


def is_json(document: Column | str) -> Column:
    """Does the document parse? The others of a "json" report are TSV text."""
    return F.try_parse_json(document).isNotNull()


def tab_records(documents: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of TSV documents whose header lists ``columns`` in any order."""
    split = documents.select(F.filter(F.split("document", "\r?\n"), lambda line: F.trim(line) != "").alias("lines"))
    body = split.select(
        F.split(F.get("lines", F.lit(0)), "\t").alias("header"),
        F.explode(F.slice("lines", F.lit(2), F.greatest(F.size("lines") - 1, F.lit(0)))).alias("line"),
    )
    schema = ", ".join(f"c{i} string" for i in range(len(columns)))
    cells = body.select("header", F.from_csv("line", schema, {"sep": "\t", "escape": '"'}).alias("cells"))
    ordered = cells.select("header", F.array(*[F.col("cells")[f"c{i}"] for i in range(len(columns))]).alias("cells"))
    position = {c: F.array_position("header", c).cast("int") for c in columns}
    return ordered.select(*[F.get("cells", position[c] - 1).alias(c) for c in columns])


def array_records(spark: SparkSession, paths: Paths, schema: T.StructType) -> DataFrame:
    """Rows of (gzipped) JSON array files, columns renamed to snake case."""
    return names.rename_all(spark.read.schema(schema).json(paths, multiLine=True), names.snake_case)


def recent_orders(documents: DataFrame, schema: T.StructType, updated: str, ref_date: Column, days: int = 30) -> DataFrame:
    """Orders of the trailing ``days``, from documents with an ``Orders`` list."""
    orders = named_records(documents, "Orders", schema)
    return orders.where(F.col(updated) >= F.date_sub(ref_date, days))


def clean_xml(document: Column) -> Column:
    """Undouble quotes, and cut text that trails the last closing root tag."""
    text = F.trim(F.replace(document, F.lit('""'), F.lit('"')), F.lit(" \t\r\n"))
    # The root is the first element: a tag that is no declaration, comment or instruction.
    root = F.regexp_extract(text, r"<([A-Za-z_][^\s/>]*)", 1)
    behind = F.call_function("substring_index", text, F.concat(F.lit("</"), root, F.lit(">")), F.lit(-1))
    whole = F.substr(text, F.lit(1), F.length(text) - F.length(behind))
    return F.when((root != "") & (whole != ""), whole).otherwise(text)


def _plain_xml(text: Column) -> Column:
    """Without comments and processing instructions, CDATA sections as escaped text; then ``<`` only begins tags."""
    bare = F.regexp_replace(text, r"(?s)(<!\[CDATA\[.*?\]\]>)|<!--.*?-->|<\?.*?\?>", "$1")
    parts = F.split(bare, r"<!\[CDATA\[", -1)

    def escaped(part: Column, k: Column) -> Column:
        inside = F.substring_index(part, "]]>", 1)
        safe = F.replace(F.replace(F.replace(inside, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
        return F.when(k == 0, part).otherwise(F.concat(safe, F.substr(part, F.length(inside) + 4)))

    return F.array_join(F.transform(parts, escaped), "")


_TAG_END = r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>"
_RANGES = "array<struct<start:int,end:int>>"


def _first_tag(text: Column, tags: Sequence[str]) -> Column:
    """The first of ``tags`` that opens an element behind the root's opening tag."""
    root = F.regexp_instr(text, F.lit(r"<[^/!?\s]"))
    below = F.substr(text, root + 1)
    return F.coalesce(*(F.when(below.rlike(rf"<{tag}[\s/>]"), F.lit(tag)) for tag in tags), F.lit(""))


def _pieces(text: Column, tag: str) -> Column:
    """The text up to every closing tag, without what follows the last."""
    parts = F.split(text, rf"</{tag}\s*>", -1)
    return F.slice(parts, 1, F.size(parts) - 1)


def _one_each(text: Column, tag: str) -> Column:
    """Does every closing tag follow exactly one opening one, and nothing open behind the last?"""
    opening = F.lit(rf"<{tag}(?=[\s/>])")
    parts = F.split(text, rf"</{tag}\s*>", -1)
    last = F.get(parts, F.size(parts) - 1)
    return F.forall(_pieces(text, tag), lambda p: F.regexp_count(p, opening) == 1) & (F.regexp_count(last, opening) == 0)


def _cut_rows(text: Column, tag: str) -> Column:
    """The elements of a tag that are neither empty nor inside each other."""
    return F.transform(_pieces(text, tag), lambda p: F.concat(F.substr(p, F.regexp_instr(p, F.lit(rf"<{tag}[\s/>]"))), F.lit(f"</{tag}>")))


def _tag_steps(texts: DataFrame, tags: Sequence[str]) -> DataFrame:
    """Opening (1), closing (-1) and empty (0) tags of documents (id, tag, root, segments) by segment: of the row tag, or of
    every element where there is none. The root's opening tag is left out."""
    every = r"[^/!?\s>]+?"
    segments = texts.select("id", "tag", "root", F.posexplode("segments").alias("at", "segment"))
    segment, steps = F.col("segment"), F.lit(None).cast("int")
    for tag, name in [(every, ""), *((t, t) for t in tags)]:
        empty = F.regexp_extract(segment, rf"^{tag}(?=[\s/>]){_TAG_END}", 0).endswith("/>")
        opens = segment.rlike(rf"^{tag}[\s/>]") & (F.col("at") > F.col("root"))
        step = F.when(opens & empty, 0).when(opens, 1).when(segment.rlike(rf"^/{tag}\s*>"), -1)
        steps = F.when(F.col("tag") == name, step).otherwise(steps)
    return segments.select("id", "tag", "at", steps.alias("step")).where("step is not null")


def _element_ranges(steps: DataFrame) -> DataFrame:
    """(id, ranges): first and last segment of the elements, in document order; without a row tag, of the root's children.

    The depth is a running sum over the tags. An element ends at the next tag of its depth; so no stack is kept,
    and only numbers are shuffled.
    """
    in_order = Window.partitionBy("id").orderBy("at")
    depth = F.sum("step").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    levels = steps.withColumn("level", depth + F.when(F.col("step") == 1, 0).otherwise(1))
    closing = F.lead("at").over(Window.partitionBy("id", "level").orderBy("at"))
    ended = levels.withColumn("end", F.when(F.col("step") == 0, F.col("at")).otherwise(closing))
    found = ended.where("step >= 0 and end is not null and (tag <> '' or level = 1)")
    return found.groupBy("id").agg(F.array_sort(F.collect_list(F.struct(F.col("at").alias("start"), "end"))).alias("ranges"))


def _element(segments: Column, part: Column, leaf: Column) -> Column:
    """The element of a range of segments; with ``leaf`` a bare text element is put inside another one."""
    first = F.get(segments, part["start"])
    whole = F.array_join(F.slice(segments, part["start"] + 1, part["end"] - part["start"]), "<")
    closed = F.concat(F.lit("<"), whole, F.lit("<"), F.regexp_extract(F.get(segments, part["end"]), "^[^>]*>", 0))
    element = F.when(part["start"] == part["end"], F.concat(F.lit("<"), F.regexp_extract(first, f"^{_TAG_END}", 0))).otherwise(closed)
    text = F.trim(F.regexp_replace(first, f"^{_TAG_END}", ""), F.lit(" \t\r\n"))
    bare = leaf & (part["end"] == part["start"] + 1) & (text != "")
    return F.when(bare, F.concat(F.lit("<row>"), element, F.lit("</row>"))).otherwise(element)


def _matched_rows(texts: DataFrame, tags: Sequence[str]) -> DataFrame:
    """Row elements of documents (text, tag) by matching tags; documents without any element but the root are one row."""
    segments = F.split("text", "<", -1)
    opens = F.transform(segments, lambda s: s.rlike("^[^/!?\\s]"))
    # The first segment is what precedes the first tag. Staged, as ids have to stay, and segments are looked up by place.
    split = texts.select(F.monotonically_increasing_id().alias("id"), "tag", segments.alias("segments"), opens.alias("opens"))
    root = F.array_position(F.slice("opens", 2, F.greatest(F.size("opens") - 1, F.lit(0))), True).cast("int")
    split = stage(split.select("id", "tag", "segments", root.alias("root")).where("root > 0"), "xml")
    ranges = _element_ranges(_tag_steps(split, tags))
    matched = split.join(broadcast_if_small(stage(ranges, "xml-ranges")), "id", "left")
    segments = F.col("segments")
    whole = F.array(F.concat(F.lit("<"), F.array_join(F.slice("segments", F.col("root") + 1, F.size("segments")), "<")))
    rows = F.transform("ranges", lambda r: _element(segments, r, F.col("tag") == ""))
    return matched.select(F.explode(F.coalesce(rows, whole)).alias("element"))


def xml_records(documents: DataFrame, schema: T.StructType, tags: Sequence[str] = ROW_TAGS) -> DataFrame:
    """Rows of XML documents: the elements of the first of ``tags`` that occurs below the root.

    Without any, the children of the root are the rows, and without children the root is. ``schema``
    describes one row element, attributes with a leading underscore and text beside attributes as
    ``_VALUE``; a child of the root that is only text is a row with its own name. Row elements may lie at
    any depth, also inside each other; each is a row. Comments hold no rows, and CDATA sections are text.

    Where rows are neither empty nor inside each other, a document is cut at their closing tags. Other documents
    are staged, and their tags matched by depth.
    """
    text = F.col("text")
    texts = documents.select(_plain_xml(clean_xml(F.col("document"))).alias("text")).where("text is not null")
    tagged = texts.select("text", _first_tag(text, tags).alias("tag"))
    plain = F.coalesce(*(F.when(F.col("tag") == tag, _one_each(text, tag)) for tag in tags), F.lit(False))
    judged = tagged.withColumn("plain", plain)
    cut = F.coalesce(*(F.when(F.col("tag") == tag, _cut_rows(text, tag)) for tag in tags))
    rows = judged.where("plain").select(F.explode(cut).alias("element"))
    others = judged.where("not plain").select("text", "tag")
    # Looked for once, so that nothing is staged or matched where there are none.
    if not others.isEmpty():
        rows = rows.unionByName(_matched_rows(others, tags))
    parsed = rows.select(F.from_xml("element", schema.simpleString()).alias("row"))
    columns = xml_row(schema, F.col("row"))
    return parsed.select(*[c.alias(name) for name, c in columns.items()])


def xml_files(spark: SparkSession, paths: Paths, tag: str, schema: T.StructType) -> DataFrame:
    """Rows of well-formed XML files whose row element is known.

    Spark splits such files between tasks, so they may be of any size.
    """
    rows = spark.read.format("xml").option("rowTag", tag).schema(schema).load(paths)
    columns = xml_row(schema, F.col("row"))
    whole = rows.select(F.struct(*schema.names).alias("row"))
    return whole.select(*[c.alias(name) for name, c in columns.items()])


def xml_root_record(documents: DataFrame, schema: T.StructType) -> DataFrame:
    """Documents without row elements: the root itself is the row."""
    parsed = documents.select(F.from_xml(clean_xml(F.col("document")), schema.simpleString()).alias("row"))
    return parsed.select(*[c.alias(name) for name, c in xml_row(schema, F.col("row")).items()])

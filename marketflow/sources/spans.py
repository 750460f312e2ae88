"""Records that span several chunks of a file, cut at their true ends although Spark splits the file anywhere.

A chunk is what lies between two separators: a line of a delimited file, or the text up to a closing brace of a
JSON file. Whether a chunk begins inside quotes depends on all chunks before it. Each chunk is
therefore first reduced to what it does to either state; these steps are summed up within every split, composed
over the few splits of a file, and carried back. Only numbers are shuffled for that; chunks move only when
their record has more than one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketflow.session import broadcast_if_small, stage
from marketflow.sources.lines import Paths, landed, numbered_chunks

_SPLIT = ["path", "split"]


class BrokenDocument(ValueError):
    """A quote or bracket that is opened in a file is never closed."""


def _so_far(*by: str, order: str):
    return Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)


def _earlier(by: str, order: str):
    return Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def _later(by: str, order: str):
    return Window.partitionBy(by).orderBy(order).rowsBetween(1, Window.unboundedFollowing)


def _odd(number: Column) -> Column:
    return F.pmod(number, F.lit(2)).cast("int")


def carried_states(steps: DataFrame) -> DataFrame:
    """``steps`` with the states ``before`` and ``after`` each, 0 or 1; every file begins with 0.

    A step (path, split, line) has ``fixed``, the state it leads to whatever was before, or null; then ``flip``
    tells whether it turns the state around. Windows cover one split, or the splits of one file.
    """
    run = _so_far(*_SPLIT, order="line")
    flips = steps.withColumn("flips", F.sum("flip").over(run))
    # Since the last fixed step, the state is its own turned around as often as steps flipped since.
    fixed = F.last(F.when(F.col("fixed").isNotNull(), _odd(F.col("fixed") + F.col("flips"))), True).over(run)
    local = stage(flips.withColumn("since", fixed).drop("fixed", "flip"), "steps")
    ends = local.groupBy(*_SPLIT).agg(F.max_by("since", "line").alias("since"), F.max_by("flips", "line").alias("flips"))
    over = _so_far("path", order="split")
    totals = ends.withColumn("all_flips", F.sum("flips").over(over))
    # ``since`` is relative to the flips of its own split; here it is made relative to all flips of the file so far.
    own = _odd(F.col("since") + F.col("all_flips") - F.col("flips"))
    last = F.last(own, True).over(over)
    after = totals.select(*_SPLIT, _odd(F.coalesce(last, F.lit(0)) + F.col("all_flips")).alias("after"))
    starts = after.select(*_SPLIT, F.coalesce(F.lag("after").over(Window.partitionBy("path").orderBy("split")), F.lit(0)).alias("start"))
    joined = local.join(broadcast_if_small(starts), _SPLIT)
    ended = joined.withColumn("after", _odd(F.coalesce("since", "start") + F.col("flips")))
    before = F.coalesce(F.lag("after").over(Window.partitionBy(*_SPLIT).orderBy("line")), F.col("start"))
    return ended.withColumn("before", before).drop("since", "flips", "start")


def _quote_end(value: Column, sep: str, inside: bool) -> Column:
    """State after a line that begins inside quotes or outside: a quote opens a field at its start only."""
    parts = F.split(value, '"', -1)

    # 0: outside, where nothing or a closing quote came last; 1: inside; 2: in a field with a quote amid its text.
    def step(state: Column, part: Column) -> Column:
        opens = ((part == "") & (state == 0)) | part.endswith(sep)
        return F.when(state == 1, 0).when(opens, 1).otherwise(2)

    quotes = F.slice(parts, 1, F.size(parts) - 1)
    return (F.aggregate(quotes, F.lit(int(inside)), step) == 1).cast("int")


def quoted_records(spark: SparkSession, paths: Paths, skip_rows: int = 0, sep: str = ",", encoding: str = "auto") -> DataFrame:
    """Records of delimited files like :func:`numbered_lines`, line breaks inside quotes kept.

    ``line`` is that of the record's first line. The first ``skip_rows`` lines stand for themselves, whatever quotes they hold.
    A file whose last quote is never closed is an error, not one long record.
    """
    lines = numbered_chunks(spark, landed(spark, paths), "\n", encoding)
    value = F.col("value")
    quoted = lines.where((F.col("line") >= skip_rows) & F.contains(value, F.lit('"')))
    ends = quoted.select(*_SPLIT, "line", _quote_end(value, sep, False).alias("outside"), _quote_end(value, sep, True).alias("inside"))
    steps = ends.select(
        *_SPLIT, "line", F.when(F.col("outside") == F.col("inside"), F.col("outside")).alias("fixed"),
        F.when(F.col("outside") > F.col("inside"), 1).otherwise(0).alias("flip"),
    )
    turns = stage(carried_states(steps).where("before <> after"), "turns")
    # Turns inside and outside alternate; the first turn of a split may close what an earlier one opened.
    closes = F.lead("line").over(Window.partitionBy(*_SPLIT).orderBy("line"))
    firsts = turns.groupBy(*_SPLIT).agg(F.min("line").alias("first_turn"))
    following = firsts.select(*_SPLIT, F.first("first_turn").over(_later("path", "split")).alias("next_turn"))
    opened = turns.withColumn("close", closes).where("after = 1").join(broadcast_if_small(following), _SPLIT)
    spans = stage(opened.select("path", F.col("line").alias("first"), F.coalesce("close", "next_turn").alias("last")), "spans")
    _raise_open(spans.where("last is null"), "a quote that is never closed")
    pieces = spans.select("path", "first", F.explode(F.sequence("first", "last")).alias("line"))
    records = _assembled(lines.drop("split"), pieces, "\n")
    return records.withColumn("value", F.regexp_replace("value", "\r$", ""))


def _raise_open(files: DataFrame, what: str) -> None:
    named = [r["path"] for r in files.select("path").distinct().orderBy("path").limit(5).collect()]
    if named:
        raise BrokenDocument(f"{what} in {', '.join(named)}")


def _assembled(chunks: DataFrame, pieces: DataFrame, glue: str) -> DataFrame:
    """``chunks`` with those of one record put together: ``pieces`` (path, line, first) names their record by its first line."""
    pieces = stage(pieces, "pieces")
    if pieces.isEmpty():
        return chunks
    tagged = chunks.join(broadcast_if_small(pieces), ["path", "line"], "left")
    values = F.transform(F.array_sort(F.collect_list(F.struct("line", "value"))), lambda p: p["value"])
    others = [c for c in chunks.columns if c not in ("path", "line", "value")]
    whole = tagged.where("first is not null").groupBy("path", F.col("first").alias("line"))
    whole = whole.agg(F.array_join(values, glue).alias("value"), *(F.first(c).alias(c) for c in others))
    return tagged.where("first is null").select(*chunks.columns).unionByName(whole.select(*chunks.columns))


_STRING = '"[^"]*+(?:"|$)'


def _structure(value: Column, inside: bool) -> Column:
    """The text of a JSON chunk outside strings."""
    plain = F.regexp_replace(value, r"(?s)\\.", "")
    if inside:
        plain = F.regexp_replace(plain, r'^[^"]*+(?:"|$)', "")
    return F.regexp_replace(plain, _STRING, "")


def _depth_change(text: Column) -> Column:
    return F.length(F.translate(text, "]}", "")) - F.length(F.translate(text, "[{", ""))


def array_members(spark: SparkSession, paths: Paths, schema: T.StructType) -> DataFrame:
    """Members of JSON files that hold one array each, however large, on one line or many.

    Spark cuts such files at closing braces. String state and bracket depth at each cut follow from those
    of all cuts before; where the depth is that of the array, a member has ended. Members are read by ``schema``;
    those that are no objects give no row. An array of arrays has no such cut and is one chunk.
    """
    files = landed(spark, paths)
    chunks = numbered_chunks(spark, files, "}", "utf-8").drop("encoding")
    chunks = chunks.withColumn("value", F.when(F.col("line") == 0, F.ltrim("value", F.lit("\ufeff"))).otherwise(F.col("value")))
    value = F.col("value")
    quotes = F.regexp_replace(value, r"(?s)\\.", "")
    flip = _odd(F.length(quotes) - F.length(F.replace(quotes, F.lit('"'), F.lit(""))))
    steps = chunks.select(
        *_SPLIT, "line", F.lit(None).cast("int").alias("fixed"), flip.alias("flip"),
        _depth_change(_structure(value, False)).alias("change_outside"), _depth_change(_structure(value, True)).alias("change_inside"),
    )
    states = carried_states(steps)
    # The brace that ended the chunk was taken off; a file's last chunk has none.
    is_last = F.col("line") == F.col("last_line")
    brace = F.when((F.col("after") == 0) & ~is_last, -1).otherwise(0)
    change = F.when(F.col("before") == 0, F.col("change_outside")).otherwise(F.col("change_inside")) + brace
    last = stage(chunks.groupBy("path").agg(F.max("line").alias("last_line")), "last")
    moved = stage(states.join(broadcast_if_small(last), "path").select(*_SPLIT, "line", "after", is_last.alias("is_last"), change.alias("change")), "moved")
    totals = moved.groupBy(*_SPLIT).agg(F.sum("change").alias("total"))
    offsets = totals.select(*_SPLIT, F.coalesce(F.sum("total").over(_earlier("path", "split")), F.lit(0)).alias("offset"))
    depth = F.col("offset") + F.sum("change").over(_so_far(*_SPLIT, order="line"))
    deep = stage(moved.join(broadcast_if_small(offsets), _SPLIT).select(*_SPLIT, "line", "after", "is_last", depth.alias("depth")), "depths")
    _raise_open(deep.where("is_last and (depth <> 0 or after <> 0)"), "a bracket or quote that is never closed")

    # A record is named by the chunk after the last end before it.
    ends = (F.col("after") == 0) & (F.col("depth") <= 1)
    ended = F.when(ends, F.col("line"))
    last_ends = deep.groupBy(*_SPLIT).agg(F.max(ended).alias("last_end"))
    before = last_ends.select(*_SPLIT, F.coalesce(F.max("last_end").over(_earlier("path", "split")), F.lit(-1)).alias("end_before"))
    previous = F.max(ended).over(Window.partitionBy(*_SPLIT).orderBy("line").rowsBetween(Window.unboundedPreceding, -1))
    named = deep.select(*_SPLIT, "line", "is_last", ends.alias("ends"), previous.alias("previous")).join(broadcast_if_small(before), _SPLIT)
    named = named.select("path", "line", "ends", "is_last", (F.coalesce("previous", "end_before") + 1).alias("first"))
    pieces = named.where("line <> first or not ends").select("path", "line", "first")

    closed = chunks.join(broadcast_if_small(last), "path")
    closed = closed.select("path", "line", F.when(is_last, value).otherwise(F.concat(value, F.lit("}"))).alias("value"))
    records = _assembled(closed, pieces, "").join(broadcast_if_small(last), "path")
    # What stands before a member and behind the last one belongs to the array.
    text = F.regexp_replace("value", r"^[\s,]*+", "")
    text = F.when(F.col("line") == 0, F.regexp_replace(text, r"^\[", "")).otherwise(text)
    tail = F.regexp_extract(text, r"(?s)^(.*)\]\s*$", 1)
    # Only the record that holds the file's last chunk ends with the array's bracket.
    holds_last = named.where("is_last").select("path", F.col("first").alias("final"))
    records = records.join(broadcast_if_small(holds_last), "path")
    body = F.when(F.col("line") == F.col("final"), tail).otherwise(text)
    records = records.select(F.concat(F.lit("["), body, F.lit("]")).alias("text"))
    # Where a member is no object the whole text is read as null; then each member is read for itself.
    each = F.transform(F.from_json("text", "array<variant>"), lambda m: F.try_variant_get(m, "$", schema.simpleString()))
    members = F.coalesce(F.from_json("text", T.ArrayType(schema)), F.filter(each, lambda m: m.isNotNull()))
    return records.select(F.inline(members))


"""Text files as numbered, decoded lines.

Spark splits large text files between tasks. Lines are counted per split, the counts
of a file are summed up over its few splits, and each line is numbered from the count
of the splits before its own: numbers are true throughout a file of any size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketflow.session import broadcast_if_small, stage

# The five byte values code page 1252 leaves undefined.
_UNDEFINED = "".join(chr(b) for b in range(0x80, 0xA0) if not bytes([b]).decode("cp1252", "ignore"))
_C1 = "".join(chr(b) for b in range(0x80, 0xA0) if chr(b) not in _UNDEFINED)
_CP1252 = _C1.encode("latin-1").decode("cp1252")

Paths = str | Sequence[str]


def _pin_splits(spark: SparkSession) -> None:
    """Keep the splits of a file the same in every scan of this session.

    Spark derives them from the number of cores, which changes while executors
    come and go; line ids of two scans would then not agree.
    """
    key = "spark.sql.files.minPartitionNum"
    if not spark.conf.get(key, None):
        spark.conf.set(key, str(spark.sparkContext.defaultParallelism))


def _latin(value: Column) -> Column:
    return F.decode(value.cast("binary"), "ISO-8859-1")


def _decoded(value: Column, encoding: Column) -> Column:
    return (
        F.when(encoding == "utf-8", value)
        .when(encoding == "cp1252", F.translate(_latin(value), _C1, _CP1252))
        .otherwise(_latin(value))
    )


def landed(spark: SparkSession, paths: Paths) -> list[str]:
    """The files of ``paths`` as they are now. All scans of a load use one listing, so a file that lands meanwhile waits."""
    return sorted(spark.read.text(paths).inputFiles())


def _raw(spark: SparkSession, files: Sequence[str], separator: str | None = None) -> DataFrame:
    _pin_splits(spark)
    return spark.read.text(list(files), lineSep=separator).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("id"),
        "value",
    )


def _files(raw: DataFrame, encoding: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Staged rows per split (first id, lines before it) and per file (encoding), and what both come from.

    With ``encoding="auto"`` each file is read as UTF-8 if all of it is valid, else
    as code page 1252, else, when it holds a byte that page lacks, as Latin-1. One
    scan; the aggregate combines before its shuffle, so each task sends one row per
    split.
    """
    value = F.col("value")
    quotes = F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))
    found = [F.min("id").alias("first_id"), F.count("*").alias("lines"), F.bool_or(quotes % 2 == 1).alias("odd")]
    if encoding == "auto":
        valid = F.is_valid_utf8("value")
        gaps = F.translate(_latin(value), _UNDEFINED, "") != _latin(value)
        found += [F.bool_and(valid).alias("utf8"), F.bool_or(~valid & gaps).alias("undefined")]
    counted = stage(raw.groupBy("path", "split").agg(*found), "splits")
    before = Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = counted.select("path", "split", "first_id", F.coalesce(F.sum("lines").over(before), F.lit(0)).alias("before"))
    if encoding == "auto":
        chosen = F.when(F.bool_and("utf8"), "utf-8").when(~F.bool_or("undefined"), "cp1252").otherwise("latin-1")
    else:
        chosen = F.lit(encoding)
    return splits, counted.groupBy("path").agg(chosen.alias("encoding")), counted


def _numbered(raw: DataFrame, splits: DataFrame) -> DataFrame:
    joined = raw.join(broadcast_if_small(splits), ["path", "split"])
    return joined.select("path", "split", (F.col("id") - F.col("first_id") + F.col("before")).alias("line"), "value")


def numbered_chunks(spark: SparkSession, files: Sequence[str], separator: str | None, encoding: str = "auto") -> DataFrame:
    """What lies between separators (null: any line break) as ``path``, ``split``, ``line`` (0-based), ``value`` and ``encoding``."""
    return _chunks_and_counts(spark, files, separator, encoding)[0]


def _chunks_and_counts(spark: SparkSession, files: Sequence[str], separator: str | None, encoding: str) -> tuple[DataFrame, DataFrame]:
    raw = _raw(spark, files, separator)
    splits, encodings, counted = _files(raw, encoding)
    lines = _numbered(raw, splits).join(broadcast_if_small(encodings), "path")
    return lines.withColumn("value", _decoded(F.col("value"), F.col("encoding"))), counted


def lines_unless_quoted(spark: SparkSession, paths: Paths, encoding: str = "auto") -> DataFrame | None:
    """:func:`numbered_lines`, or null if some line has an odd number of quotes, so that a record may go on in the next line.

    The scan that counts the lines tells.
    """
    lines, counted = _chunks_and_counts(spark, landed(spark, paths), None, encoding)
    return None if counted.where("odd").limit(1).count() else lines.drop("split")


def numbered_lines(spark: SparkSession, paths: Paths, encoding: str = "auto") -> DataFrame:
    """Lines as ``path``, ``line`` (0-based), ``value`` and the file's ``encoding``, which ``value`` is decoded by."""
    return numbered_chunks(spark, landed(spark, paths), None, encoding).drop("split")


def heads_of(lines: DataFrame, line: int = 0, skip_blank: bool = False) -> DataFrame:
    """One staged row per file: ``head``, its ``line``, and ``head_line``, where that is.

    With ``skip_blank`` the head is the first line from there on that is not blank.
    Files without such a line have a null head.
    """
    usable = (F.col("line") >= line) & (F.trim("value") != "") if skip_blank else F.col("line") == line
    at = F.when(usable, F.col("line"))
    return stage(lines.groupBy("path").agg(F.min(at).alias("head_line"), F.min_by("value", at).alias("head")), "heads")


def file_labels(spark: SparkSession, paths: Paths, label: str, line: int = 0) -> DataFrame:
    """Per file the label in its metadata line: ``Brand=["X"]`` gives ``X``."""
    pattern = label + r'=\["?([^"\]]*)'
    found = F.regexp_extract("head", pattern, 1)
    heads = heads_of(numbered_lines(spark, paths, "utf-8"), line)
    return heads.where("head is not null").select("path", F.nullif(found, F.lit("")).alias("label"))


def listed_files(spark: SparkSession, paths: Paths) -> DataFrame:
    """File names and modification times; contents are not read."""
    files = spark.read.format("binaryFile").load(paths)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "path", "modificationTime")

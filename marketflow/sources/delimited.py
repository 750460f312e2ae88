"""Delimited report files: CSV, TSV, exported sheets.

Every column is text; types come later, from the report's contract.
"""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketflow.functions.names import header_names
from marketflow.session import broadcast_if_small, stage
from marketflow.sources.lines import Paths, heads_of, lines_unless_quoted, numbered_lines
from marketflow.sources.spans import quoted_records

# Cell texts that mean "no value".
NULL_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


class MixedReports(ValueError):
    """The paths of one load hold different header lines where one is needed."""


class EmptyReport(ValueError):
    """A file of the load has lines, but no header line; or no file has any."""


def read_delimited(
    spark: SparkSession,
    paths: Paths,
    skip_rows: int = 0,
    sep: str = ",",
    encoding: str = "auto",
    multi_line: bool | None = None,
    path_column: str | None = None,
    as_written: bool = False,
) -> DataFrame:
    """Rows of delimited files whose header follows ``skip_rows`` lines.

    The header is the first line from there on that is not blank.

    Files may order their columns differently, or lack some: each is read by its
    own header, and columns are matched by name. All files are read in one scan.
    Line breaks inside quotes are part of a cell: if some line has an odd number of quotes, records are cut where
    quotes are closed, also in files that are split between tasks. ``multi_line`` says beforehand that there are
    such records, or that every line is one. Line breaks before the header always end a line.

    Cells that spell "no value" become null and repeated header names get a suffix;
    ``as_written`` keeps the cells' text and the first of repeated columns only.
    """
    kept = {path_column: F.col("path")} if path_column else {}
    lines = None
    if not multi_line:
        lines = numbered_lines(spark, paths, encoding) if multi_line is False else lines_unless_quoted(spark, paths, encoding)
    if lines is None:
        lines = quoted_records(spark, paths, skip_rows, sep, encoding)
    heads = heads_of(lines, skip_rows, skip_blank=True).withColumn("head", F.ltrim("head", F.lit("\ufeff")))
    layouts = _layouts(heads, paths)
    data = lines.join(broadcast_if_small(heads), "path").where((F.col("line") > F.col("head_line")) & (F.trim("value") != ""))
    cells = {head: next(csv.reader([head], delimiter=sep)) for head in layouts}
    if as_written:
        return _parsed(data, {head: _unnamed(row) for head, row in cells.items()}, sep, kept).na.fill("")
    return _with_nulls(_parsed(data, {head: header_names(row) for head, row in cells.items()}, sep, kept))


def _layouts(heads: DataFrame, paths: Paths) -> list[str]:
    """The different header lines; they make up the schema, so the driver has to see them."""
    lacking = [row["path"] for row in heads.where("head is null").select("path").orderBy("path").limit(5).collect()]
    if lacking:
        raise EmptyReport(f"no header line in {', '.join(lacking)}")
    layouts = sorted(row["head"] for row in heads.select("head").distinct().collect())
    if not layouts:
        raise EmptyReport(f"no lines in {paths}")
    return layouts


def _unnamed(cells: list[str]) -> list[str]:
    """Header cells as they are, except that blank ones get a position."""
    return [cell or f"Unnamed: {i}" for i, cell in enumerate(cells)]


def _parsed(data: DataFrame, layouts: dict[str, list[str]], sep: str, kept: dict[str, Column]) -> DataFrame:
    """Lines as columns. Each line is parsed once into cells; the layout of its file tells where a column's cell is."""
    width = max(map(len, layouts.values()))
    columns = list(dict.fromkeys(name for layout in layouts.values() for name in layout))
    schema = ", ".join(f"c{i} string" for i in range(width))
    cells = F.from_csv(F.col("value"), schema, {"sep": sep, "escape": '"'})
    rows = data.select(cells.alias("_cells"), "head", *[c.alias(f"_kept_{name}") for name, c in kept.items()])
    extra = [F.col(f"_kept_{name}").alias(name) for name in kept]
    if len(layouts) == 1:
        (layout,) = layouts.values()
        return rows.select(*[F.col(f"_cells.c{layout.index(name)}").alias(name) for name in columns], *extra)
    places = [(head, [layout.index(name) if name in layout else -1 for name in columns]) for head, layout in layouts.items()]
    known = data.sparkSession.createDataFrame(places, "head string, _places array<int>")
    placed = rows.join(broadcast_if_small(known.withColumn("_places", F.array_join("_places", ","))), "head")
    placed = placed.withColumn("_places", F.split("_places", ",").cast("array<int>"))
    placed = placed.withColumn("_cells", F.array(*[F.col(f"_cells.c{i}") for i in range(width)]))

    def cell(k: int) -> Column:
        place = F.element_at("_places", k + 1)
        return F.when(place >= 0, F.get("_cells", place)).alias(columns[k])

    return placed.select(*[cell(k) for k in range(len(columns))], *extra)


def _with_nulls(df: DataFrame) -> DataFrame:
    quoted = {c: F.col(f"`{c.replace('`', '``')}`") for c in df.columns}
    return df.select(*[F.when(~c.isin(*NULL_WORDS), c).alias(name) for name, c in quoted.items()])


def read_tsv(spark: SparkSession, paths: Paths, encoding: str = "utf-8") -> DataFrame:
    return read_delimited(spark, paths, sep="\t", encoding=encoding)


def read_sheet(spark: SparkSession, paths: Paths, header_row: int = 0) -> DataFrame:
    """An exported sheet; cells stay as written, blank ones as empty text, and of
    repeated columns the first is kept.

    ``header_row`` counts the lines above the real header: sheets often carry a
    title row and a group row first.
    """
    return read_delimited(spark, paths, skip_rows=header_row, as_written=True)


def row_positions(spark: SparkSession, paths: Paths, sep: str = ",", encoding: str = "utf-8", continued: bool = False) -> DataFrame:
    """Data rows of sheets with their 0-based position below the header.

    With ``continued`` the files are parts of one sheet, each with the header: positions run on from one to the next,
    in the order of their names.
    """
    lines = numbered_lines(spark, paths, encoding)
    heads = heads_of(lines)
    layouts = _layouts(heads, paths)
    if len(layouts) != 1:
        raise MixedReports(f"positions need files of one layout: {paths}")
    layout = header_names(next(csv.reader(layouts, delimiter=sep)))
    body = lines.where("line > 0")
    position = F.col("line") - 1
    if continued:
        # One row per file.
        counts = stage(lines.groupBy("path").agg(F.max("line").alias("rows")), "rows")
        before = Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
        offsets = counts.select("path", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
        body = body.join(broadcast_if_small(offsets), "path")
        position = position + F.col("offset")
    body = body.select("value", position.alias("position"), F.lit(layouts[0]).alias("head"))
    return _parsed(body, {layouts[0]: layout}, sep, {"position": F.col("position")})

"""The report jobs: what each report is read with, stamped with and loaded by."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketflow.functions import coerce, names, periods
from marketflow.operators import dedup, load, projections
from marketflow.operators.projections import Contract, Field
from marketflow.session import stage
from marketflow.sinks import tables
from marketflow.sources import delimited, documents


@dataclass(frozen=True)
class Report:
    """One report type.

    ``source`` names its scan, ``skip_rows`` the lines before its header, ``stamp``
    what is stamped on its rows (``today``, ``yesterday``, ``date``, ``period`` or
    ``sku``), ``load`` its discipline with ``keys`` or ``date_column``, ``period``
    the dates it covers, and ``fields`` the columns whose type is fixed.
    """

    name: str
    dataset: str
    source: str = "csv"
    skip_rows: int = 0
    stamp: str = ""
    load: str = "insert_if_new"
    keys: tuple[str, ...] = ()
    date_column: str = ""
    period: str = ""
    rule: str = "warehouse"
    fields: Contract = ()


def _campaign(name: str) -> Report:
    return Report(
        name, "api_ad", source="json_array", load="keyed_replace", keys=("campaign_id", "start_date", "end_date"),
        period="refetch_days", rule="snake",
        fields=(Field("campaign_id", "long"), Field("start_date", "timestamp"), Field("end_date", "timestamp")),
    )


# The report types, with the columns, keys and line counts their
# files are known to have.
REPORTS = {
    r.name: r
    for r in (
        Report("fba_inventory", "fulfillment", load="keyed_replace", keys=("snapshot_date", "sku"),
               fields=(Field("snapshot_date", "timestamp"), Field("sku"))),
        Report("manage_fba_inventory", "fulfillment", stamp="today", load="keyed_replace", keys=("date", "sku"),
               fields=(Field("date", "timestamp"), Field("sku"))),
        Report("promotions", "fulfillment"),
        Report("fba_customer_returns", "fulfillment"),
        Report("replacements", "fulfillment", period="reload_months"),
        Report("fulfilled_shipments", "fulfillment", period="reload_months"),
        Report("reimbursements", "fulfillment", period="previous_month"),
        Report("inventory_surcharge", "fulfillment", period="previous_month"),
        Report("storage_fees", "fulfillment", stamp="today", period="previous_month"),
        Report("order_detail", "fulfillment", period="full_year"),
        Report("shipment_detail", "fulfillment", period="full_year"),
        Report("transaction", "payments", skip_rows=7, load="month_replace", date_column="date_time",
               period="reload_months",
               fields=(Field("date_time", "timestamp"), Field("order_postal", "string", coercion="postal"))),
        Report("sales_traffic_daily", "business_reports", stamp="date", period="single_days"),
        Report("sales_traffic_weekly", "business_reports", stamp="period", period="last_week"),
        Report("brand_performance", "business_reports", stamp="period", period="last_week"),
        Report("competitors", "business_reports", source="sheet", stamp="period", period="trailing_week"),
        Report("inventory", "awd", skip_rows=3, stamp="today"),
        Report("shipment_awd_inbound", "awd", stamp="today", period="current_month"),
        Report("storage", "awd", stamp="today", period="previous_month"),
        Report("processing", "awd", stamp="today", period="previous_month"),
        Report("transportation", "awd", stamp="today", period="previous_month"),
        Report("shipments", "shipments", stamp="today", period="previous_month"),
        Report("support", "support"),
        Report("brand_share", "brand_analytics", skip_rows=1, load="append_dedup", rule="share",
               fields=(Field("reporting_date", "timestamp"),)),
        Report("asin", "brand_analytics", skip_rows=1, stamp="sku"),
        Report("search_performance", "brand_analytics", source="search_records", period="search_week", rule="asis",
               fields=(Field("reporting_date", "date"),)),
        Report("rank_tracker", "rank_tracker", rule="simple", period="yesterday",
               fields=(Field("date", "date"), Field("amazon_choice_badge", "boolean", coercion="yes_no"))),
        _campaign("sponsored_campaign"),
        Report("seller_api", "api_sp", source="tsv", stamp="yesterday", rule="camel", period="yesterday"),
    )
}

_RULES: dict[str, Callable[[str], str]] = {
    "warehouse": names.warehouse_name,
    "camel": lambda name: names.warehouse_name(name, camel=True),
    "snake": names.snake_case,
    "simple": names.simple_name,
    "share": lambda name: names.share_name(names.cloud_name(name)),
    "asis": lambda name: name,
}

# What a report covers, as an array of spans, for a reference date.
COVERED: dict[str, Callable[[Column], Column]] = {
    "current_month": lambda d: F.array(periods.current_month(d)),
    "previous_month": lambda d: F.array(periods.previous_month(d)),
    "full_year": lambda d: F.array(periods.full_year(d)),
    "last_week": lambda d: F.array(periods.last_week(d)),
    "trailing_week": lambda d: F.array(periods.trailing_week(d)),
    "search_week": lambda d: F.array(periods.search_week(d)),
    "yesterday": lambda d: F.array(periods.days_ago(d, 1)),
    "single_days": lambda d: F.array(periods.days_ago(d, 1), periods.days_ago(d, 3)),
    "refetch_days": lambda d: F.transform(periods.refetch_days(d), lambda x: F.struct(x.alias("start_date"), x.alias("end_date"))),
    "reload_months": lambda d: F.transform(
        periods.reload_months(d), lambda m: F.struct(m.alias("start_date"), F.last_day(m).alias("end_date"))
    ),
}


@dataclass(frozen=True)
class Loaded:
    """Outcome of a load: the table's new state and what was noticed on the way.

    ``nulled`` counts, per date or time column, texts that read as no date.
    """

    state: DataFrame | None
    loaded: bool
    dropped: tuple[str, ...] = ()
    contract: Contract = ()
    nulled: tuple[tuple[str, int], ...] = ()


def family(name: str) -> Report:
    """The report by its table name; all ``_campaign`` tables share one definition."""
    if name in REPORTS:
        return REPORTS[name]
    if name.endswith("_campaign"):
        return replace(REPORTS["sponsored_campaign"], name=name)
    raise KeyError(name)


def scan_report(spark: SparkSession, report: Report, paths, encoding: str = "auto", schema: T.StructType | None = None) -> DataFrame:
    """All files of a report as one batch; delimited ones have text columns only.

    ``schema`` is that of the members of JSON reports. Without it the members of an
    array are read by the types found in all files.
    """
    if report.source == "tsv":
        return delimited.read_tsv(spark, paths)
    if report.source == "sheet":
        return delimited.read_sheet(spark, paths, report.skip_rows)
    if report.source == "csv":
        return delimited.read_delimited(spark, paths, report.skip_rows, encoding=encoding)
    if report.source == "json_array":
        found = schema or spark.read.json(paths, multiLine=True).schema
        return documents.array_records(spark, paths, found)
    if report.source == "search_records":
        if schema is None:
            raise ValueError(f"{report.name} needs the schema of its records")
        return documents.named_records(documents.read_documents(spark, paths), documents.SEARCH_RECORDS, schema)
    raise ValueError(f"{report.name}: unknown source {report.source!r}")


def prepared(
    report: Report, raw: DataFrame, ref_date: date | str, custom_date: date | str | None = None,
    period: str | None = None, sku: str | None = None,
) -> DataFrame:
    """Clean names, then stamps."""
    day = date.fromisoformat(str(ref_date))
    given = {"custom_date": custom_date, "period": period, "sku": sku}
    if report.stamp == "today":
        given["add_date"] = day
    elif report.stamp == "yesterday":
        given["custom_date"] = custom_date or date.fromordinal(day.toordinal() - 1)
    return projections.stamp_all(names.rename_all(raw, _RULES[report.rule]), **given)


def first_contract(report: Report, batch: DataFrame) -> Contract:
    """Types of a first load: inferred, except for the report's fixed fields."""
    fixed = {f.name: f for f in report.fields}
    return tuple(fixed.get(f.name, f) for f in projections.infer_contract(batch))


def load_batch(
    report: Report, raw: DataFrame, target: DataFrame | None, ref_date: date | str,
    contract: Contract | None = None, **stamps,
) -> Loaded:
    """Prepare a raw batch, conform it to the stored contract and load it.

    Without a target this is a first load, and the contract is inferred. An empty
    batch leaves the table as it is. The batch is staged: emptiness, types and percent
    columns are decided on all of it before its rows are used, so that its files are
    parsed only once. Where the contract is known and no text decides anything, it is
    staged once, as the table wants it.
    """
    typed, staged = _typed(report, raw, target, ref_date, contract, **stamps)
    if not typed.loaded:
        return Loaded(target, False)
    return replace(typed, state=_disciplined(report, target, typed.state, staged))


def _typed(
    report: Report, raw: DataFrame, target: DataFrame | None, ref_date: date | str, contract: Contract | None, **stamps
) -> tuple[Loaded, bool]:
    """The batch itself as the table wants it, and whether it is staged as such."""
    if contract is None and target is not None:
        contract = _stored(report, target)
    typed = None if contract is None else _plainly_typed(report, raw, ref_date, contract, **stamps)
    if typed is not None:
        typed, dropped = stage(typed[0], "batch"), typed[1]
        return (Loaded(None, False) if typed.isEmpty() else Loaded(typed, True, dropped, contract)), True
    raw = stage(raw, "scan")
    if raw.isEmpty():
        return Loaded(None, False), False
    batch = prepared(report, raw, ref_date, **stamps)
    if contract is None:
        contract = first_contract(report, batch)
    typed = projections.conform(batch, contract)
    dropped = tuple(projections.dropped_columns(batch, contract))
    return Loaded(typed, True, dropped, contract, _nulled(batch, contract)), False


def _plainly_typed(
    report: Report, raw: DataFrame, ref_date: date | str, contract: Contract, **stamps
) -> tuple[DataFrame, tuple[str, ...]] | None:
    """The conformed batch and its dropped columns, where no rows have to be looked at for that."""
    try:
        batch = prepared(report, raw, ref_date, **stamps)
        if projections.percent_texts(batch, contract) or _temporal_texts(batch, contract):
            return None
        return projections.conform(batch, contract), tuple(projections.dropped_columns(batch, contract))
    except (ValueError, AnalysisException):
        # Unusable columns are an error only where there are rows.
        return None


def _temporal_texts(batch: DataFrame, contract: Contract) -> list[Field]:
    kinds = dict(batch.dtypes)
    return [f for f in contract if f.kind in ("date", "timestamp") and kinds.get(f.name) == "string"]


def _nulled(batch: DataFrame, contract: Contract) -> tuple[tuple[str, int], ...]:
    """Texts of date and time columns that are not empty and read as no date, by one aggregate."""
    temporal = _temporal_texts(batch, contract)
    if not temporal:
        return ()
    lost = [
        F.count_if((F.trim(f.name) != "") & coerce.to_text(f.name).isNotNull() & coerce.to_timestamp(f.name, f.formats).isNull()).alias(f.name)
        for f in temporal
    ]
    return tuple((n, c) for n, c in batch.agg(*lost).first().asDict().items() if c)


def _stored(report: Report, target: DataFrame) -> Contract:
    fixed = {f.name: f for f in report.fields}
    kept = []
    for f in projections.contract_of(target):
        known = fixed.get(f.name)
        kept.append(replace(known, kind=f.kind if known.kind != "date" else "date") if known else f)
    return tuple(kept)


def _disciplined(report: Report, target: DataFrame | None, batch: DataFrame, staged: bool) -> DataFrame:
    if target is None:
        return dedup.dedup_loads(batch) if report.load == "append_dedup" else batch.dropDuplicates()
    if report.load == "keyed_replace":
        return load.keyed_replace(target, batch, report.keys, staged=staged)
    if report.load == "month_replace":
        return load.month_replace(target, batch, report.date_column, staged)
    if report.load == "append_dedup":
        return dedup.dedup_loads(load.append(target, batch))
    return load.insert_if_new(target, batch, staged=staged)


def load_report(
    spark: SparkSession, report: Report, paths, target: DataFrame | None, ref_date: date | str,
    encoding: str = "auto", contract: Contract | None = None, schema: T.StructType | None = None, **stamps,
) -> Loaded:
    """Files to the new state of the report's table."""
    raw = scan_report(spark, report, paths, encoding, schema)
    return load_batch(report, raw, target, ref_date, contract, **stamps)


def load_into(
    spark: SparkSession, report: Report, paths, name: str, ref_date: date | str, partition: str | None = None,
    encoding: str = "auto", contract: Contract | None = None, schema: T.StructType | None = None, **stamps,
) -> Loaded:
    """Files into the catalog table ``name``, which a first load creates.

    Only what the report's discipline touches is written: new rows are appended, keys and
    months are replaced in the partitions of ``partition`` that the batch has. A column of
    that name is stored as it is; ``month`` is derived from the report's date column.
    """
    raw = scan_report(spark, report, paths, encoding, schema)
    known = spark.catalog.tableExists(name)
    target = spark.read.table(name) if known else None
    derived = partition == "month" and bool(report.date_column)
    if known and derived:
        target = target.drop(partition)
    outcome, staged = _typed(report, raw, target, ref_date, contract, **stamps)
    if not outcome.loaded:
        return Loaded(target, False)
    batch = outcome.state if staged else stage(outcome.state, "typed")
    if derived:
        batch = batch.withColumn(partition, F.coalesce(F.date_format(report.date_column, "yyyy-MM"), F.lit("none")))
    if not known:
        writer = _disciplined(report, None, batch, True).write
        (writer.partitionBy(partition) if partition else writer).saveAsTable(name)
    elif report.load == "insert_if_new":
        tables.insert_new(batch, name)
    elif report.load == "append_dedup":
        tables.append_content(batch, name)
    elif partition and report.load == "month_replace":
        tables.replace_months(batch, name, report.date_column, partition)
    elif partition and report.load == "keyed_replace":
        tables.replace_keys_in_partitions(batch, name, report.keys, partition)
    else:

        def rewrite() -> None:
            version = tables.table_version(spark, name)
            tables.replace_table(_disciplined(report, spark.read.table(name), batch, not derived), name, version)

        tables.retried(rewrite)
    return replace(outcome, state=spark.read.table(name))


def covered_periods(days: DataFrame, day: str) -> DataFrame:
    """For each day the spans every report covers, one row per report and span."""

    def named(report: Report) -> Column:
        spans = COVERED[report.period](F.col(day).cast("date"))
        name = F.lit(report.name).alias("report")
        return F.transform(spans, lambda s: F.struct(name, s["start_date"].alias("start_date"), s["end_date"].alias("end_date")))

    per_report = [named(r) for r in REPORTS.values() if r.period]
    return days.select(day, F.inline(F.concat(*per_report)))

"""Stamps, contract conformance and contract inference."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketflow.functions import coerce

# Spark type of each contract type.
KINDS = {
    "long": "bigint",
    "double": "double",
    "boolean": "boolean",
    "timestamp": "timestamp_ntz",
    "date": "date",
    "string": "string",
}


@dataclass(frozen=True)
class Field:
    """A stored column: its name, its contract type and its date patterns."""

    name: str
    kind: str = "string"
    formats: tuple[str, ...] = ()
    coercion: str = ""  # "postal" or "yes_no" where the type alone does not decide

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"{self.name}: unknown contract type {self.kind!r}")


Contract = tuple[Field, ...]


def contract(**kinds: str) -> Contract:
    """``contract(sku="string", units="long")``."""
    return tuple(Field(name, kind) for name, kind in kinds.items())


def kind_of(type_name: str) -> str:
    """Contract type of a database or frame type name, by the first word it contains."""
    text = type_name.lower()
    rules = [
        ("long", ("int", "long")),
        ("double", ("double", "float", "numeric", "decimal")),
        ("boolean", ("bool",)),
        ("timestamp", ("timestamp", "date")),
    ]
    return next((kind for kind, words in rules if any(w in text for w in words)), "string")


def contract_of(df: DataFrame) -> Contract:
    """The contract a typed frame already satisfies."""
    return tuple(Field(name, kind_of(kind)) for name, kind in df.dtypes)


def stamp(
    df: DataFrame,
    ref_date: date | str | None = None,
    period: str | None = None,
    custom_date: date | str | None = None,
    sku: str | None = None,
) -> DataFrame:
    """Put one constant first column, unless the name is taken.

    Of the given values the first of period, custom date, sku counts; with none
    of them the load date ``ref_date`` is stamped.
    """
    choices = [("period", period), ("date", custom_date), ("sku", sku), ("date", ref_date)]
    name, value = next((c for c in choices if c[1]), (None, None))
    if name is None or name in df.columns:
        return df
    return df.select(F.lit(str(value)).alias(name), "*")


def stamp_all(
    df: DataFrame,
    add_date: date | str | None = None,
    custom_date: date | str | None = None,
    period: str | None = None,
    sku: str | None = None,
) -> DataFrame:
    """Every given stamp in turn, the later ones further left."""
    for choice in ({"ref_date": add_date}, {"custom_date": custom_date}, {"period": period}, {"sku": sku}):
        df = stamp(df, **choice)
    return df


def _coerced(field: Field, percent: Column) -> Column:
    if field.coercion:
        return getattr(coerce, field.coercion)(F.col(field.name))
    c = F.col(field.name)
    return {
        "long": lambda: coerce.to_long(c),
        "double": lambda: coerce.to_double(c, percent),
        "boolean": lambda: coerce.to_flag(c),
        "timestamp": lambda: coerce.to_timestamp(c, field.formats),
        "date": lambda: coerce.to_date(c, field.formats),
        "string": lambda: coerce.to_text(c),
    }[field.kind]()


def percent_texts(df: DataFrame, fields: Contract) -> list[str]:
    """Text columns whose rows decide together whether they hold percentages."""
    kinds = dict(df.dtypes)
    return [f.name for f in fields if f.kind == "double" and kinds.get(f.name) == "string" and not f.coercion]


def conform(df: DataFrame, fields: Contract) -> DataFrame:
    """The batch as the stored schema wants it, in one ``select``.

    Missing columns become typed nulls, present ones are coerced, extra ones are
    dropped. Columns that already have the stored type pass untouched. Whether a
    money column holds percentages is decided once for the whole batch, by one
    aggregate over all such text columns, used as a scalar subquery.
    """
    kinds = dict(df.dtypes)

    def needs_work(f: Field) -> bool:
        return bool(f.coercion) or f.kind == "string" or kinds[f.name] != KINDS[f.kind]

    texts = percent_texts(df, fields)
    flags = {}
    if texts:
        found = df.agg(F.struct(*[coerce.has_percent(n).alias(n) for n in texts]).alias("percent")).scalar()
        flags = {n: found[n] for n in texts}

    columns = []
    for f in fields:
        if f.name not in kinds:
            column = F.lit(None)
        elif needs_work(f):
            column = _coerced(f, flags.get(f.name, F.lit(False)))
        else:
            column = F.col(f.name)
        columns.append(column.cast(KINDS[f.kind]).alias(f.name))
    return df.select(*columns)


def dropped_columns(df: DataFrame, fields: Contract) -> list[str]:
    """Batch columns that :func:`conform` leaves out."""
    stored = {f.name for f in fields}
    return [c for c in df.columns if c not in stored]


# The types a text may read as, one bit each, the narrowest first.
_READS_AS = ("long", "double", "boolean", "timestamp")


def _kinds_mask(value: Column) -> Column:
    """One bit for every type that a text reads as. Whole numbers are numbers too; otherwise a text reads as one type, so the
    dear attempts come last."""
    bit = {kind: 1 << k for k, kind in enumerate(_READS_AS)}
    whole = value.rlike(coerce.WHOLE) & value.try_cast("long").isNotNull()
    return (
        F.when(whole, bit["long"] | bit["double"])
        .when(coerce.number(value).isNotNull(), bit["double"])
        .when(value.isin("True", "False"), bit["boolean"])
        .when(value.rlike(coerce.DATE_START) & coerce.to_timestamp(value).isNotNull(), bit["timestamp"])
        .otherwise(0)
    )


def infer_contract(df: DataFrame) -> Contract:
    """First-load contract of an all-text batch, by one aggregate over its rows.

    A column gets the first type that every value it has reads as; a column without any value stays text. The
    cells are unpivoted and reduced to one mask of types each, so the plan is the same for any number of columns;
    masks combine before the shuffle to one row per column and task.
    """
    texts = [name for name, kind in df.dtypes if kind == "string"]
    if not texts:
        return contract_of(df)
    # A backslash and a backtick may be part of a report's column name.
    quoted = [F.col(f"`{name.replace('`', '``')}`") for name in texts]
    cells = df.select(F.posexplode(F.array(*quoted)).alias("place", "cell"))
    # Every cell is trimmed once, not in each of the attempts that follow.
    trimmed = cells.where(coerce.to_text("cell").isNotNull()).select("place", F.explode(F.array(F.trim("cell"))).alias("value"))
    masks = trimmed.groupBy("place").agg(F.bit_and(_kinds_mask(F.col("value"))).alias("mask")).collect()
    found = {texts[row["place"]]: row["mask"] for row in masks}
    fields = []
    for name, kind in df.dtypes:
        if kind == "string":
            fits = [k for bit, k in enumerate(_READS_AS) if found.get(name, 0) & (1 << bit)]
            fields.append(Field(name, fits[0] if fits else "string"))
        else:
            fields.append(Field(name, kind_of(kind)))
    return tuple(fields)


# Columns of order reports that are flags.
ORDER_FLAGS = (
    "is_business_order",
    "signature_confirmation_recommended",
    "IsPremiumOrder",
    "IsISPU",
    "IsPrime",
    "IsSoldByAB",
    "IsBusinessOrder",
    "HasRegulatedItems",
    "IsAccessPointOrder",
    "IsGlobalExpressEnabled",
    "IsReplacementOrder",
)
SESSIONS_COLUMN = "Sessions _ Browser"


def cloud_types(df: DataFrame, table: str) -> DataFrame:
    """Per-table casts of the cloud warehouse: sessions, reporting date, order flags."""
    changes = {c: F.col(c).cast("boolean") for c in ORDER_FLAGS if c in df.columns}
    if SESSIONS_COLUMN in df.columns:
        sessions = F.col(f"`{SESSIONS_COLUMN}`")
        changes[SESSIONS_COLUMN] = (
            coerce.to_long(sessions) if table == "sales_traffic_daily" else sessions.cast("string")
        )
    if "reporting_date" in df.columns:
        changes["reporting_date"] = coerce.to_timestamp("reporting_date")
    return df.withColumns(changes) if changes else df

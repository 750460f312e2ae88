"""Column-name rules: pure functions over names, applied with one ``toDF``."""

from __future__ import annotations

import re
import string
from collections import Counter
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame

# Name length limits of the two warehouse dialects, the words names are
# spelled with, and the prefix of names that would start with a digit.
WAREHOUSE_NAME_LIMIT = 63
CLOUD_NAME_LIMIT = 128
PERCENT = "percent"
LONG_PERCENT, SHORT_PERCENT = "percentage", "pct"
DIGIT_PREFIX = "col_"

_PUNCTUATION = str.maketrans({mark: PERCENT if mark == "%" else "_" for mark in string.punctuation})
_WORD_BREAK = re.compile(r"(?<=[A-Za-z])(?=\d)|(?<=[a-z])(?=[A-Z])")


class NameCollision(ValueError):
    """Two source columns clean to the same name."""


def snake_case(name: str) -> str:
    """``campaignName14d`` to ``campaign_name_14d``; runs of capitals stay whole."""
    return _WORD_BREAK.sub("_", name).lower()


def warehouse_name(name: str, camel: bool = False) -> str:
    """Lower-case identifier for warehouse tables."""
    text = snake_case(name) if camel else name.lower()
    return _identifier(text.replace(" ", "_").replace(LONG_PERCENT, SHORT_PERCENT), WAREHOUSE_NAME_LIMIT)


def cloud_name(name: str) -> str:
    """Identifier that keeps letter case and spaces."""
    return _identifier(name, CLOUD_NAME_LIMIT)


def simple_name(name: str) -> str:
    """Spaces to underscores and lower case, nothing else."""
    return name.replace(" ", "_").lower()


def share_name(name: str) -> str:
    """Like :func:`simple_name`, with one pass that halves double underscores."""
    return name.replace(" ", "_").replace("__", "_").lower()


def _identifier(text: str, limit: int) -> str:
    text = re.sub("__+", "_", text.translate(_PUNCTUATION)).strip("_")
    return (DIGIT_PREFIX + text if text[:1].isdigit() else text)[:limit]


def rename_all(df: DataFrame, rule: Callable[[str], str]) -> DataFrame:
    """Apply a name rule to every column; fail when two columns collide."""
    names = [rule(name) for name in df.columns]
    taken = Counter(names)
    clashes = {new: [old for old, n in zip(df.columns, names) if n == new] for new in names if taken[new] > 1}
    if clashes:
        raise NameCollision(f"columns clean to the same name: {clashes}")
    return df.toDF(*names)


def clean_names(df: DataFrame, camel: bool = False) -> DataFrame:
    return rename_all(df, lambda name: warehouse_name(name, camel))


def clean_names_cloud(df: DataFrame) -> DataFrame:
    return rename_all(df, cloud_name)


def keep_first_of_repeated(df: DataFrame) -> DataFrame:
    """Drop columns whose exact name already occurred further left."""
    placed = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    first: dict[str, int] = {}
    for i, name in enumerate(df.columns):
        first.setdefault(name, i)
    return placed.select(*[placed[f"_{i}"].alias(name) for name, i in first.items()])


def header_names(cells: Iterable[str | None]) -> list[str]:
    """Names for a parsed header line: blanks get a position, repeats a suffix."""
    names: list[str] = []
    seen: Counter[str] = Counter()
    for i, cell in enumerate(cells):
        base = cell if cell else f"Unnamed: {i}"
        name = base
        while name in names:
            seen[base] += 1
            name = f"{base}.{seen[base]}"
        names.append(name)
    return names


# Published field names of the search-performance report and the
# column names they load under.
SEARCH_PERFORMANCE_COLUMNS = {
    "searchQuery": "search_query",
    "searchQueryScore": "search_query_score",
    "searchQueryVolume": "search_query_volume",
    "totalQueryImpressionCount": "impressions_total_count",
    "asinImpressionCount": "impressions_asin_count",
    "asinImpressionShare": "impressions_asin_share_percent",
    "totalClickCount": "clicks_total_count",
    "totalClickRate": "clicks_click_rate_percent",
    "asinClickCount": "clicks_asin_count",
    "asinClickShare": "clicks_asin_share_percent",
    "totalMedianClickPrice": "clicks_price_median",
    "asinMedianClickPrice": "clicks_asin_price_median",
    "totalSameDayShippingClickCount": "clicks_same_day_shipping_speed",
    "totalOneDayShippingClickCount": "clicks_1d_shipping_speed",
    "totalTwoDayShippingClickCount": "clicks_2d_shipping_speed",
    "totalCartAddCount": "cart_adds_total_count",
    "totalCartAddRate": "cart_adds_cart_add_rate_percent",
    "asinCartAddCount": "cart_adds_asin_count",
    "asinCartAddShare": "cart_adds_asin_share_percent",
    "totalMedianCartAddPrice": "cart_adds_price_median",
    "asinMedianCartAddPrice": "cart_adds_asin_price_median",
    "totalSameDayShippingCartAddCount": "cart_adds_same_day_shipping_speed",
    "totalOneDayShippingCartAddCount": "cart_adds_1d_shipping_speed",
    "totalTwoDayShippingCartAddCount": "cart_adds_2d_shipping_speed",
    "totalPurchaseCount": "purchases_total_count",
    "totalPurchaseRate": "purchases_purchase_rate_percent",
    "asinPurchaseCount": "purchases_asin_count",
    "asinPurchaseShare": "purchases_asin_share_percent",
    "totalMedianPurchasePrice": "purchases_price_median",
    "asinMedianPurchasePrice": "purchases_asin_price_median",
    "totalSameDayShippingPurchaseCount": "purchases_same_day_shipping_speed",
    "totalOneDayShippingPurchaseCount": "purchases_1d_shipping_speed",
    "totalTwoDayShippingPurchaseCount": "purchases_2d_shipping_speed",
}

# Fixed value: the repeat-purchase report renames its flattened money column.
REPEAT_PURCHASE_COLUMNS = {"amount": "repeat_purchase_revenue"}


def rename_search_performance(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(SEARCH_PERFORMANCE_COLUMNS)


def rename_repeat_purchase(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(REPEAT_PURCHASE_COLUMNS)

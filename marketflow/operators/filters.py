"""Row filters and listing rules."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketflow.functions import coerce, markup, periods

# Listing type and document state that mark a usable report, and
# link endings and prefixes that lead to no page.
LISTING_TYPE = 16
READY = "DONE"
FILE_ENDINGS = (".pdf", ".jpg", ".png", ".zip")
NO_PAGE_PREFIXES = ("#", "mailto:", "tel:")
RETENTION_DAYS = 5
RECENT_HOURS = 1


def matching(df: DataFrame, **values) -> DataFrame:
    """Rows equal to every value given; empty values do not constrain."""
    return df.where(coerce.all_of([F.col(name) == F.lit(v) for name, v in values.items() if v]))


def named_like(df: DataFrame, column: str, part: str = "_campaign") -> DataFrame:
    return df.where(F.contains(F.col(column), F.lit(part)))


def failed_recent(tasks: DataFrame, now: datetime | str, hours: int = RECENT_HOURS, status: str = "failed") -> DataFrame:
    """Tasks with ``status`` in the trailing hours, both ends included."""
    end = F.lit(str(now)).cast("timestamp_ntz")
    start = end - F.expr(f"interval {int(hours)} hours")
    return tasks.where((F.col("status") == status) & F.col("created_at").between(start, end))


def listed_reports(
    listing: DataFrame, wanted: DataFrame, key: str, day: Column, today: Column, kind: int = LISTING_TYPE
) -> DataFrame:
    """Listing rows of one type that cover exactly ``day``, were created ``today``
    (UTC) and belong to a wanted key."""
    rows = listing.where(
        (F.col("reportType") == kind)
        & (F.to_date("from") == day)
        & (F.to_date("to") == day)
        & (coerce.utc_day("createdAt") == today)
    )
    return rows.join(wanted.select(key).distinct(), key, "left_semi")


def first_per_key(df: DataFrame, key: str, position: str) -> DataFrame:
    """The row of each key that is listed first."""
    others = [c for c in df.columns if c != key]
    first = df.groupBy(key).agg(F.min_by(F.struct(*others), position).alias("_row"))
    return first.select(*[F.col(key) if c == key else F.col(f"_row.`{c}`") for c in df.columns])


def first_ready(listing: DataFrame, position: str, status: str = "processingStatus") -> DataFrame:
    """The first ready document of a listing."""
    return listing.where(F.col(status) == READY).orderBy(position).limit(1)


def expired(files: DataFrame, name: str, ref_date, days: int = RETENTION_DAYS) -> DataFrame:
    """Files whose name carries a date at least ``days`` old."""
    dated = files.withColumn("file_date", coerce.file_name_date(name))
    return dated.where(F.col("file_date") <= F.date_sub(periods.ref(ref_date), days))


def month_pages(
    df: DataFrame, page: str, text: str, current: str, previous: str, max_pages: int | None = None
) -> DataFrame:
    """Which pages of a paged listing hold rows of two months, and which are kept.

    Reading goes on while a page mentions either month; of the pages read, those
    with rows of the previous month are kept. A row that mentions both counts for
    the current month. ``max_pages`` bounds the reading, as a listing reader would.
    """
    is_current = F.contains(F.col(text), F.lit(current))
    is_previous = ~is_current & F.contains(F.col(text), F.lit(previous))
    pages = df.groupBy(page).agg(
        F.coalesce(F.bool_or(is_current), F.lit(False)).alias("has_current"),
        F.coalesce(F.bool_or(is_previous), F.lit(False)).alias("has_previous"),
    )
    neither = ~F.col("has_current") & ~F.col("has_previous")
    stop = pages.agg(F.min(F.when(neither, F.col(page))).alias("stop")).scalar()
    read = stop.isNull() | (F.col(page) < stop)
    if max_pages is not None:
        read = read & (F.col(page) < max_pages)
    return pages.withColumn("kept", F.col("has_previous") & read)


# Rows one task may sort to find a position, values sampled to cut a column into ranges, and ranges of one pass.
RANK_ROWS = 200_000
RANK_SAMPLE = 4_096
RANK_RANGES = 256


def _range_number(value: Column, cuts: list, first: int = 0) -> Column:
    """How many of the sorted ``cuts`` do not exceed the value, by bisection."""
    if not cuts:
        return F.lit(first)
    middle = len(cuts) // 2
    below, above = _range_number(value, cuts[:middle], first), _range_number(value, cuts[middle + 1 :], first + middle + 1)
    return F.when(value < cuts[middle], below).otherwise(above)


def value_at(df: DataFrame, order: str, position: int, most: int = RANK_ROWS) -> Column | None:
    """The value at a 0-based position in the order of a unique column, as a literal; null beyond the end.

    A bounded sample cuts the column into ranges, whose rows are counted in the map tasks. The range that
    holds the position is cut again until it has at most ``most`` rows; only these are sorted.
    """
    kind = df.schema[order].dataType
    here = df.select(order).where(F.col(order).isNotNull())
    total = here.count()
    if position >= total:
        return None
    while total > most:
        share = F.pmod(F.xxhash64(order), F.lit(1 << 40)) < max(1, (RANK_SAMPLE << 40) // total)
        sample = sorted(row[0] for row in here.where(share).collect())
        if not sample:
            break
        cuts = [F.lit(v).cast(kind) for v in sample[:: max(1, len(sample) // RANK_RANGES)]]
        ranged = here.groupBy(_range_number(F.col(order), cuts).alias("range"))
        counted = ranged.agg(F.count("*").alias("n"), F.min(order).alias("low"), F.max(order).alias("high")).orderBy("range").collect()
        before = 0
        for part in counted:
            if position < before + part["n"]:
                break
            before += part["n"]
        if part["n"] == total:
            break
        here = here.where(F.col(order).between(*(F.lit(part[b]).cast(kind) for b in ("low", "high"))))
        position, total = position - before, part["n"]
    found = here.orderBy(order).limit(position + 1).agg(F.max(order)).first()[0]
    return F.lit(found).cast(kind)


def row_slice(df: DataFrame, order: str, start: int, stop: int | None = None, most: int = RANK_ROWS) -> DataFrame:
    """Rows ``start`` to ``stop`` (included, 0-based) in the order of a unique column; nulls have no position.

    The two bounding values are found by counting ranges; the rows between them are a plain range filter, which
    reaches the scan. No task sorts or sees more than a bounded number of rows for it.
    """
    first = value_at(df, order, start, most)
    if first is None:
        return df.limit(0)
    rows = df.where(F.col(order) >= first)
    last = value_at(df, order, stop, most) if stop is not None else None
    return rows if last is None else rows.where(F.col(order) <= last)


def page_links(pages: DataFrame, url: str = "url", html: str = "html", same_host: bool = True) -> DataFrame:
    """Links of each page as ``href`` and resolved ``target``, with both hosts.

    Tags are read as a browser reads them: any quotes or none, any case, character references, and nothing from comments
    or scripts; ``<base>`` moves what links are relative to. In-page anchors, mail and phone links and file downloads
    are left out.
    """
    marked = pages.withColumn("_markup", markup.markup_only(F.col(html)))
    anchors = F.transform(markup.tags(F.col("_markup"), "a"), lambda tag: markup.attribute(tag, "href"))
    moved = F.transform(markup.tags(F.col("_markup"), "base"), lambda tag: markup.attribute(tag, "href"))
    marked = marked.select(*pages.columns, anchors.alias("_anchors"), F.get(F.filter(moved, lambda h: h.isNotNull()), F.lit(0)).alias("_moved"))
    # Each step is a column of its own, as resolving uses its parts many times.
    links = marked.select(*pages.columns, "_moved", F.explode("_anchors").alias("_written"))
    links = links.withColumns({"_moved": markup.decoded_references(F.col("_moved")), "_written": markup.decoded_references(F.col("_written"))})
    # Line breaks and tabs are no part of an address, nor are the blanks around it.
    links = links.withColumn("href", F.trim(F.regexp_replace("_written", r"[\t\r\n]", "")))
    links = links.withColumn("_base", F.coalesce(resolved_link(F.col("_moved"), F.col(url)), F.col(url))).drop("_written", "_moved")
    prefixes, endings = ("|".join(map(re.escape, words)) for words in (NO_PAGE_PREFIXES, FILE_ENDINGS))
    links = links.where(~F.col("href").rlike(rf"^$|^(?:{prefixes})|(?:{endings})$"))
    links = links.withColumn("target", resolved_link(F.col("href"), F.col("_base"))).drop("_base")
    links = links.withColumns({"page_host": host(F.col(url)), "target_host": host(F.col("target"))})
    return links.where(F.lower("page_host") == F.lower("target_host")) if same_host else links


def host(url: Column) -> Column:
    """Host and port of an absolute URL."""
    return F.nullif(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit(""))


def resolved_link(href: Column, base: Column) -> Column:
    """``href`` as seen from the page ``base``: absolute, host, root or folder relative."""

    def joined(h: Column, b: Column) -> Column:
        scheme = F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
        site = F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
        page = F.regexp_extract(b, r"^([^?#]*)", 1)
        folder = F.regexp_extract(F.concat(page, F.when(page == site, "/").otherwise("")), r"^(.*/)", 1)
        return (
            F.when(h.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), h)
            .when(h.startswith("//"), F.concat(scheme, F.lit(":"), h))
            .when(h.startswith("/"), F.concat(site, h))
            .when(h.startswith("?"), F.concat(page, h))
            .otherwise(F.concat(folder, h))
        )

    whole = coerce.let(F.struct(href.alias("href"), base.alias("base")), lambda v: joined(v["href"], v["base"]))
    return coerce.let(whole, _without_dot_segments)


def _without_dot_segments(url: Column) -> Column:
    """Remove ``.`` and ``..`` segments of the path, if there are any."""
    site = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    rest = F.substring(url, F.char_length(site) + 1, F.char_length(url))
    path = F.regexp_extract(rest, r"^([^?#]*)", 1)
    tail = F.substring(rest, F.char_length(path) + 1, F.char_length(rest))
    segments = F.split(F.regexp_replace(path, r"/\.{1,2}$", "$0/"), "/")
    start = F.array().cast("array<string>")
    kept = F.aggregate(
        segments,
        start,
        lambda done, s: F.when(s == ".", done)
        .when(s == "..", F.when(F.size(done) > 1, F.slice(done, 1, F.size(done) - 1)).otherwise(done))
        .otherwise(F.concat(done, F.array(s))),
    )
    return F.when(path.rlike(r"(^|/)\.{1,2}(/|$)"), F.concat(site, F.array_join(kept, "/"), tail)).otherwise(url)

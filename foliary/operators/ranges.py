"""Page ranges: islands, splits, interval joins and greedy packing."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import zip_longest

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def coalesce_ranges(flagged: DataFrame, buffer: int = 1, merge_gap: int = 2, key: str = "doc_id", page: str = "page_index", total: str = "total_pages") -> DataFrame:
    """(key, start, end): flagged pages widened by ``buffer``, clamped, and merged where the gap is at most ``merge_gap``."""
    if min(buffer, merge_gap) < 0:
        raise ValueError("buffer and merge_gap must be 0 or more")
    wide = flagged.where(F.col(total) > 0).select(key, F.greatest(F.lit(0), F.col(page) - buffer).alias("start"), F.least(F.col(total) - 1, F.col(page) + buffer).alias("end")).distinct()
    order = Window.partitionBy(key).orderBy("start", "end")
    reach = wide.withColumn("reach", F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    fresh = F.when(F.col("reach").isNull() | (F.col("start") - F.col("reach") > merge_gap), 1).otherwise(0)
    island = reach.withColumn("island", F.sum(fresh).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return island.groupBy(key, "island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("island")


def pages_in_ranges(pages: DataFrame, ranges: DataFrame, key: str = "doc_id", page: str = "page_index") -> DataFrame:
    """Pages with the range they lie in (null outside): ranges are spread to pages, so the join is an equi-join."""
    spread = ranges.select(key, F.explode(F.sequence("start", "end")).alias(page), F.col("start").alias("range_start"), F.col("end").alias("range_end"))
    return pages.join(spread, [key, page], "left")


def split_ranges(total: Column, max_pages: int, overlap: int = 2) -> Column:
    """array<struct<chunk, start, stop>>: one chunk if the pages fit, else overlapping ones, each ``max_pages - overlap`` after the one before."""
    if max_pages <= overlap or overlap < 0:
        raise ValueError("max_pages must exceed an overlap of 0 or more")
    stride = max_pages - overlap
    chunk = lambda s: F.struct((s / stride).cast("int").alias("chunk"), s.alias("start"), F.least(s + max_pages, total).alias("stop"))
    whole = F.array(F.struct(F.lit(0).alias("chunk"), F.lit(0).alias("start"), total.cast("int").alias("stop")))
    return F.when(total > max_pages, F.transform(F.sequence(F.lit(0), total - 1, F.lit(stride)), chunk)).when(total > 0, whole).otherwise(F.array().cast("array<struct<chunk:int,start:int,stop:int>>"))


def _packed(counts: Sequence[int | None], ocr: Sequence[bool | None] | None, most: int, ocr_most: int) -> list[int]:
    """Group numbers of one document's items. A comparison with an unknown number or class opens no group."""
    out, group, total, was = [], -1, 0, None
    for n, is_ocr in zip_longest(counts, [False] * len(counts) if ocr is None else ocr):
        over = total is not None and n is not None and total + n > (ocr_most if is_ocr else most)
        if group < 0 or (was is not None and is_ocr is not None and was != is_ocr) or over:
            group, total = group + 1, 0
        total = None if total is None or n is None else total + n
        was = is_ocr
        out.append(group)
    return out


def greedy_groups(counts: Column, max_pages: int, needs_ocr: Column | None = None, ocr_max_pages: int = 8) -> Column:
    """Group number of each item, in order: a group closes when the next item would exceed its cap, or is of another class.

    An item larger than the cap stands alone. The recurrence is sequential and
    its state is three numbers; one pass in Python, as a fold in Spark copies
    what it has so far at each item.
    """
    if min(max_pages, ocr_max_pages) < 1:
        raise ValueError("caps must be 1 or more")

    @F.pandas_udf("array<int>")
    def of_one(counts: pd.Series) -> pd.Series:
        return pd.Series([None if c is None else _packed(c.tolist(), None, max_pages, ocr_max_pages) for c in counts], dtype=object)

    @F.pandas_udf("array<int>")
    def of_two(counts: pd.Series, ocr: pd.Series) -> pd.Series:
        return pd.Series([None if c is None or o is None else _packed(c.tolist(), o.tolist(), max_pages, ocr_max_pages) for c, o in zip(counts, ocr, strict=True)], dtype=object)

    return of_one(counts) if needs_ocr is None else of_two(counts, needs_ocr)


def heading_bands(runs: DataFrame, key: str = "doc_id", size: str = "font_size") -> DataFrame:
    """Adds ``level``: the largest min(n-1, 3) of n >= 2 distinct sizes become levels 1, 2, 3; other runs have 0.

    Sizes are ranked on the distinct pairs, so a document with many runs costs a join, not a window over them.
    """
    sizes = runs.select(key, size).distinct()
    order = Window.partitionBy(key).orderBy(F.desc(size))
    ranked = sizes.select(key, size, F.row_number().over(order).alias("rank"), F.count("*").over(Window.partitionBy(key)).alias("n"))
    level = F.when(F.col("rank") <= F.least(F.col("n") - 1, F.lit(3)), F.col("rank")).otherwise(0)
    return runs.join(ranked.select(key, size, level.cast("int").alias("level")), [key, size])


def gap_variation(rows: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """(key, cv): variation of the gaps between positions in order, at most 1; 0 for fewer than three positions or no gap."""
    w = Window.partitionBy(key).orderBy(order)
    gaps = rows.select(key, F.abs(F.col(value) - F.lag(value).over(w)).alias("gap"))
    cv = F.when((F.count("gap") < 2) | (F.avg("gap") == 0), 0.0).otherwise(F.least(F.lit(1.0), F.stddev_pop("gap") / F.avg("gap")))
    return gaps.groupBy(key).agg(F.coalesce(cv, F.lit(0.0)).alias("cv"))


def stitch_markers(pages: DataFrame, overlap: int, key: str = "doc_id") -> DataFrame:
    """Pages of overlapping chunks (key, chunk, position, text) without the repeated ones: adds ``page`` from 1 and ``marked``, the text under its marker.

    A chunk after the first loses its first ``overlap`` pages, unless it has no more than those.
    """
    size = F.count("*").over(Window.partitionBy(key, "chunk"))
    kept = pages.withColumn("size", size).where((F.col("chunk") == 0) | (F.col("size") <= overlap) | (F.col("position") >= overlap)).drop("size")
    numbered = kept.withColumn("page", F.row_number().over(Window.partitionBy(key).orderBy("chunk", "position")))
    body = F.regexp_replace("text", r"\s+$", "")
    return numbered.withColumn("marked", F.concat(F.format_string("<!-- page %d -->", "page"), F.when(body != "", F.concat(F.lit("\n"), body)).otherwise("")))


def stitch_bodies(bodies: Column) -> Column:
    """Chunk bodies joined by a blank line; a leading H1 that repeats the last H1 kept so far is dropped."""
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(None).cast("string").alias("last"))
    h1s = lambda b: F.regexp_extract_all(b, F.lit(r"(?m)^# +(.+?)\s*$"), F.lit(1))

    def step(acc: Column, body: Column) -> Column:
        lead = F.nullif(F.regexp_extract(body, r"^\s*# +([^\n]+?)\s*(?:\n|$)", 1), F.lit(""))
        clean = F.when(lead == acc["last"], F.regexp_replace(body, r"^((?:[^\S\n]*\n)*)#\s[^\n]*(?:\n|$)", "$1")).otherwise(body)
        kept = ~clean.rlike(r"^\s*$")
        return F.struct(F.when(kept, F.array_append(acc["out"], clean)).otherwise(acc["out"]).alias("out"), F.coalesce(F.when(kept, F.try_element_at(h1s(clean), F.lit(-1))), acc["last"]).alias("last"))

    return F.aggregate(bodies, start, step, lambda acc: F.array_join(acc["out"], "\n\n"))

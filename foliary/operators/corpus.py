"""Corpus statistics: deduplication, sampling, engine comparison, surveys, fits and verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliary.functions.ids import content_sha256


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(content_sha256, n, keep): groups of equal bodies and the smallest id of each."""
    return docs.select(id_col, content_sha256(F.col(text_col)).alias("content_sha256")).groupBy("content_sha256").agg(F.count("*").alias("n"), F.min(id_col).alias("keep"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each body, that of the smallest id. Only ids and hashes are shuffled for the choice."""
    keep = exact_duplicates(docs, id_col, text_col).select(F.col("keep").alias(id_col))
    return docs.join(keep, id_col, "left_semi")


def seeded_rank(seed: int, key: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def seeded_sample(rows: DataFrame, k: int, seed: int, key: str) -> DataFrame:
    """k rows chosen by a hash of seed and key: the same for any partitioning."""
    return rows.withColumn("_r", seeded_rank(seed, F.col(key))).orderBy("_r", key).limit(k).drop("_r")


def stratified_sample(rows: DataFrame, per_group: int, seed: int, group: str, key: str) -> DataFrame:
    """Up to ``per_group`` rows of each group by the same hash; the limit per group is applied before and after the shuffle."""
    w = Window.partitionBy(group).orderBy(seeded_rank(seed, F.col(key)), key)
    return rows.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= per_group).drop("_n")


def similarity_histogram(pairs: DataFrame, similarity: str = "similarity") -> DataFrame:
    s = F.col(similarity)
    count = lambda cond, name: F.count_if(cond).cast("bigint").alias(name)
    return pairs.agg(F.count("*").alias("pairs"), count(s >= 0.9, "ge_090"), count((s >= 0.7) & (s < 0.9), "ge_070"), count((s >= 0.5) & (s < 0.7), "ge_050"), count(s < 0.5, "lt_050"))


def engine_statistics(rows: DataFrame, group: str, value: str) -> DataFrame:
    v = F.col(value).cast("double")
    return rows.groupBy(group).agg(
        F.count("*").alias("n"), F.sum(v).alias("total"), F.avg(v).alias("mean"), F.median(v).alias("median"), F.min(v).alias("least"), F.max(v).alias("most"),
        F.when(F.count("*") >= 2, F.stddev_samp(v)).alias("deviation"),
    )


def verdict(delta: Column, margin: float) -> Column:
    return F.when(delta > margin, "wins").when(delta < -margin, "loses").otherwise("tied")


def page_bucket(pages: Column) -> Column:
    return F.when(pages <= 5, "small").when(pages <= 30, "medium").otherwise("large")


def survey(docs: DataFrame, group: str, chars: str) -> DataFrame:
    """Counts, sums, means and medians per group, and over all in the row with a null group."""
    c = F.col(chars).cast("double")
    return docs.rollup(group).agg(F.count("*").alias("files"), F.sum(c).alias("chars"), F.avg(c).alias("mean_chars"), F.median(c).alias("median_chars"))


def peak_fit(rows: DataFrame, peak: str, load: str) -> DataFrame:
    """Least squares of peak = base + k * load over rows whose outcome is ok."""
    ok = rows.where("outcome = 'ok'")
    return ok.agg(F.regr_intercept(F.col(peak), F.col(load)).alias("base"), F.regr_slope(F.col(peak), F.col(load)).alias("k"), F.count("*").alias("n"))


def exclusive_percentile(rows: DataFrame, group: str, value: str, n: int, k: int) -> DataFrame:
    """(group, percentile): the k-th of the n - 1 cut points of each group's values, between two of them in proportion; null of one value alone.

    Values are ranked in a sort that may spill; no array of a group is made.
    """
    w = Window.partitionBy(group)
    ranked = rows.select(group, F.col(value).cast("double").alias("_x"), F.row_number().over(w.orderBy(value)).alias("_r"), F.count("*").over(w).alias("_n"))
    at = F.lit(k) * (F.col("_n") + 1) / n
    low = F.greatest(F.lit(1), F.least(F.col("_n") - 1, F.floor(at)))
    near = ranked.withColumns({"_at": at, "_low": low}).where((F.col("_r") == F.col("_low")) | (F.col("_r") == F.col("_low") + 1))
    x, y = F.max(F.when(F.col("_r") == F.col("_low"), F.col("_x"))), F.max(F.when(F.col("_r") > F.col("_low"), F.col("_x")))
    return near.groupBy(group).agg((x + (y - x) * (F.max("_at") - F.max("_low"))).alias("percentile"))


def merge_gap_verdict(runs: DataFrame) -> DataFrame:
    """(best_gap, baseline_gap): of runs (merge_gap, wall_s, qa), the fastest of those at least 5 % faster than the largest gap with no worse QA; else that one."""
    base = runs.agg(F.max("merge_gap").alias("baseline_gap"), F.max_by("wall_s", "merge_gap").alias("base_s"), F.max_by("qa", "merge_gap").alias("base_qa"))
    fit = runs.crossJoin(F.broadcast(base)).where((F.col("wall_s") <= F.col("base_s") * 0.95) & (F.col("qa") >= F.col("base_qa")))
    best = fit.agg(F.min_by("merge_gap", F.struct("wall_s", "merge_gap")).alias("best"))
    return base.crossJoin(best).select(F.coalesce("best", "baseline_gap").alias("best_gap"), "baseline_gap")


def quality_summary(metrics: DataFrame, names: tuple[str, ...] = ("structural_density_per_1k", "heading_count", "section_count", "table_cell_count")) -> DataFrame:
    """(metric, mean, median) of quality metrics over all pages, to three places; 0 of no page."""
    each = metrics.select(F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names])).alias("m")).select("m.*")
    found = each.groupBy("metric").agg(F.round(F.avg("value"), 3).alias("mean"), F.round(F.median("value"), 3).alias("median"))
    listed = metrics.sparkSession.createDataFrame([(n,) for n in names], "metric string")
    return listed.join(found, "metric", "left").select("metric", F.coalesce("mean", F.lit(0.0)).alias("mean"), F.coalesce("median", F.lit(0.0)).alias("median"))


def h1_rescue(docs: DataFrame, group: str, text: str = "text") -> DataFrame:
    """Bodies by how a missing title can be made up for, per group and in all: a short first line (a), a usable first paragraph (b), or not."""
    t = F.col(text)
    a, b = F.length(F.substring_index(t, "\n", 1)).between(3, 60), F.length(F.trim(F.substring_index(t, "\n\n", 1))).between(40, 2000)
    flags = docs.select(group, t.startswith("#").alias("h1"), a.alias("a"), b.alias("b"))
    tiers = {"with_h1": "h1", "tier_a": "not h1 and a", "tier_b": "not h1 and not a and b", "unrescued": "not h1 and not a and not b"}
    return flags.rollup(group).agg(*[F.count_if(F.expr(cond)).alias(name) for name, cond in tiers.items()])


def agreement(rows: DataFrame, votes: list[Column], told: Column, gate: float = 0.85) -> DataFrame:
    """(agreement, passes): share of rows where two votes or more say what ``told`` says, against the gate."""
    truth = sum((v.cast("int") for v in votes), F.lit(0)) >= 2
    return rows.agg(F.avg((truth == told).cast("double")).alias("agreement")).select("agreement", (F.col("agreement") >= gate).alias("passes"))

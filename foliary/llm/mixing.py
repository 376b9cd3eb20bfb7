"""Mixing sources to target weights by iterative proportional fitting.

Tokens are summed per cell (source, language, topic); the cell weights are
raked to the target marginals of the three in turn until they hold; documents
are sampled with the probability of their cell. Up to MOST_CELLS cells the
fit runs in arrays on the driver, with more the same steps run as joins and
sums of a table of cells; either gives every category its own target.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliary.llm.common import discard, materialise

AXES = ("source", "lang", "topic")
#: Cells that are fitted on the driver, and those that are joined by broadcast (of some 100 bytes each).
MOST_CELLS, BROADCAST_CELLS = 1_000_000, 100_000
#: Name of all categories that given targets leave out.
POOL = "(other)"
#: Rounds of the fit at most, and how close (as a share of all) the marginals must be to end it.
ROUNDS, CLOSE = 500, 1e-9


def topic_of(text: Column) -> Column:
    """A coarse genre from native predicates, for tables without a topic column."""
    t = F.coalesce(text, F.lit(""))
    size = F.length(t)
    lines = size - F.length(F.replace(t, F.lit("\n"), F.lit("")))
    return (
        F.when(t.contains("Licensed under") | t.contains("License,") | t.contains("Copyright"), "licence")
        .when(t.contains("@") | t.contains("://"), "contact")
        .when(t.contains("###") | t.contains("|"), "markup")
        .when(size < 400, "short")
        .when(lines * 120 > size, "lines")
        .when(size > 8000, "long")
        .otherwise("prose")
    )


def word_count(text: Column) -> Column:
    """Words as the measure of tokens where no count is at hand: single spaces and line feeds end words."""
    t = F.coalesce(text, F.lit(""))
    return F.length(t) - F.length(F.translate(t, " \n\t", "")) + F.when(F.length(t) > 0, 1).otherwise(0)


def tempered_shares(weight: np.ndarray, power: float) -> np.ndarray:
    """Shares proportional to weight to the power: under 1 small categories gain."""
    raised = np.where(weight > 0, weight, 0.0) ** power
    return raised / raised.sum() if raised.sum() else raised


def rake(weights: np.ndarray, codes: list[np.ndarray], targets: list[np.ndarray], rounds: int = ROUNDS, close: float = CLOSE) -> np.ndarray:
    """Scale cell weights until each axis' sums meet its target shares.

    ``codes[a][c]`` is cell c's category on axis a. A target of a category
    without weight is dropped and the others of its axis scaled up. Marginals
    that cannot all be met (cells are missing) end at the fit after ``rounds``.
    """
    w = weights.astype(float).copy()
    total = w.sum()
    if total <= 0:
        return w
    goals = []
    for code, share in zip(codes, targets, strict=True):
        there = np.bincount(code, weights=w, minlength=len(share)) > 0
        kept = np.where(there, share, 0.0)
        goals.append(kept / kept.sum() * total if kept.sum() else np.where(there, total / there.sum(), 0.0))
    for _ in range(rounds):
        worst = 0.0
        for code, goal in zip(codes, goals, strict=True):
            now = np.bincount(code, weights=w, minlength=len(goal))
            factor = np.divide(goal, now, out=np.ones_like(now), where=now > 0)
            worst = max(worst, float(np.abs(now - goal).max()) / total)
            w *= factor[code]
        if worst < close:
            break
    return w


def probabilities(observed: np.ndarray, wanted: np.ndarray, budget: float) -> np.ndarray:
    """Inclusion probabilities min(1, c * wanted/observed) whose expected weight is the budget's share of what is observed."""
    ratio = np.divide(wanted, observed, out=np.zeros_like(wanted, dtype=float), where=observed > 0)
    goal, p = min(1.0, budget) * observed.sum(), np.zeros_like(ratio)
    full = np.zeros(len(ratio), bool)
    while True:
        rest = goal - observed[full].sum()
        free = (observed * ratio)[~full].sum()
        c = rest / free if free > 0 else 0.0
        p = np.where(full, 1.0, np.clip(c * ratio, 0.0, None))
        over = (p > 1) & ~full
        if not over.any():
            return np.clip(p, 0.0, 1.0)
        full |= over


def pooled_targets(given: Mapping[str, float], left_out: float) -> dict[str, float]:
    """Given shares, scaled to leave the categories that have none their observed share."""
    if POOL in given or left_out <= 0:
        return dict(given)
    return {k: v * (1 - left_out) for k, v in given.items()} | {POOL: left_out}


def _fitted(sums: DataFrame, targets: Mapping[str, Mapping[str, float]], power: float, budget: float) -> DataFrame:
    """The cells and their probabilities, from arrays on the driver."""
    cells = sums.toArrow()
    observed = cells["tokens"].to_numpy().astype(float)
    codes, goals = [], []
    for axis in AXES:
        coded = cells[axis].combine_chunks().dictionary_encode()
        names, code = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        weight = np.bincount(code, weights=observed, minlength=len(names))
        if axis in targets:
            share = pooled_targets(targets[axis], sum(w for n, w in zip(names, weight, strict=True) if n not in targets[axis]) / max(1.0, observed.sum()))
            at = {n: i for i, n in enumerate(share)}
            code = np.array([at.get(n, at.get(POOL, 0)) for n in names])[code]
        else:
            share = dict(enumerate(tempered_shares(weight, power)))
        codes.append(code)
        goals.append(np.array(list(share.values()), float))
    p = probabilities(observed, rake(observed, codes, goals), budget)
    return sums.sparkSession.createDataFrame(cells.select(list(AXES)).append_column("probability", pa.array(np.where(observed > 0, p, budget))))


def _fitted_as_table(sums: DataFrame, targets: Mapping[str, Mapping[str, float]], power: float, budget: float) -> DataFrame:
    """The same fit with cells that stay distributed; only sums over all come to the driver."""
    spark = sums.sparkSession
    total = float(sums.agg(F.sum("tokens")).first()[0] or 0)
    now = sums
    for axis in AXES:
        named = F.when(F.col(axis).isin(list(targets[axis])), F.col(axis)).otherwise(POOL) if axis in targets else F.col(axis)
        now = now.withColumn(f"c_{axis}", named)
    now = materialise(now.withColumn("w", F.col("tokens").cast("double")))
    goals = {}
    for axis in AXES:
        marginal = now.groupBy(f"c_{axis}").agg(F.sum("tokens").cast("double").alias("seen")).where("seen > 0")
        if axis in targets:
            left = marginal.where(F.col(f"c_{axis}") == POOL).first()
            share = pooled_targets(targets[axis], 0.0 if left is None else left["seen"] / max(1.0, total))
            marginal = marginal.join(F.broadcast(spark.createDataFrame(list(share.items()), f"c_{axis} string, raised double")), f"c_{axis}")
        else:
            marginal = marginal.withColumn("raised", F.pow("seen", F.lit(power)))
        marginal = materialise(marginal)
        all_, n = marginal.agg(F.sum("raised"), F.count("*")).first()
        goals[axis] = marginal.select(f"c_{axis}", (F.col("raised") / all_ * total if all_ else F.lit(total / max(1, n))).alias("goal"))
    for _ in range(ROUNDS):
        worst = 0.0
        for axis in AXES:
            factor = materialise(now.groupBy(f"c_{axis}").agg(F.sum("w").alias("sum")).join(goals[axis], f"c_{axis}", "left"))
            off = factor.agg(F.max(F.abs(F.col("sum") - F.coalesce("goal", F.lit(0.0))))).first()[0] or 0.0
            worst = max(worst, off / max(1.0, total))
            scaled = now.join(factor, f"c_{axis}").withColumn("w", F.when(F.col("sum") > 0, F.col("w") * F.coalesce("goal", F.lit(0.0)) / F.col("sum")).otherwise(F.col("w"))).select(*now.columns)
            before, now = now, materialise(scaled)
            discard(before, factor)
        if worst < CLOSE:
            break
    ratio = F.when(F.col("tokens") > 0, F.col("w") / F.col("tokens")).otherwise(0.0)
    goal, c, full = min(1.0, budget) * total, 0.0, -1
    while True:
        over = F.lit(c) * ratio > 1 if full >= 0 else F.lit(False)
        many, heavy, free = now.agg(F.count_if(over), F.sum(F.when(over, F.col("tokens")).otherwise(0)), F.sum(F.when(~over, F.col("tokens") * ratio).otherwise(0.0))).first()
        if many <= full:
            break
        full, c = many, (goal - (heavy or 0)) / free if free else c
    return now.select(*AXES, F.when(F.col("tokens") > 0, F.least(F.lit(1.0), F.lit(max(c, 0.0)) * ratio)).otherwise(budget).alias("probability"))


def mix(
    docs: DataFrame,
    budget: float = 0.8,
    targets: Mapping[str, Mapping[str, float]] | None = None,
    power: float = 0.7,
    seed: int = 42,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokens_col: str | None = None,
    most_cells: int = MOST_CELLS,
) -> DataFrame:
    """(id, source, lang, topic, tokens, probability, kept boolean) of every row.

    ``targets`` gives shares per axis; an axis left out gets the observed
    shares of all its categories tempered by ``power``. Categories that given
    shares do not name are one and keep their observed share. A null category
    is a category of its own. ``tokens_col`` names a column of token counts;
    without it words are counted. ``kept`` compares a hash of seed and id with
    the probability, so it does not change with partitioning; rows of equal id
    are kept or left together, those without an id by their text. ``budget`` is
    the share of tokens kept in expectation. Texts without tokens weigh
    nothing; their cells have the budget as probability.
    """
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("(none)")) if c in docs.columns else F.lit("(none)")
    topic = named("topic") if "topic" in docs.columns else topic_of(F.col(text_col))
    tokens = word_count(F.col(text_col)) if tokens_col is None else F.coalesce(F.col(tokens_col), F.lit(0))
    drawn_by = F.xxhash64(F.lit(seed), F.col(id_col), F.when(F.col(id_col).isNull(), F.col(text_col)))
    rows = docs.select(F.col(id_col).alias("id"), named("source").alias("source"), named("lang").alias("lang"), topic.alias("topic"), tokens.cast("bigint").alias("tokens"), drawn_by.alias("by"))
    rows = materialise(rows)  # texts are looked at once; what is kept of them is narrow
    sums = materialise(rows.groupBy(*AXES).agg(F.sum("tokens").alias("tokens")))
    n = sums.count()
    cells = (_fitted if n <= most_cells else _fitted_as_table)(sums, targets or {}, power, budget)
    if n <= BROADCAST_CELLS:
        cells = F.broadcast(cells)
    draw = (F.col("by").cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return rows.join(cells, list(AXES)).select(F.col("id").alias(id_col), *AXES, "tokens", "probability", (draw < F.col("probability")).alias("kept"))

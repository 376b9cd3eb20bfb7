"""Triage, then repair: cheap text of every page, scores, ranges of weak pages, the expensive engine on those only."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliary.batches import bound_batches
from foliary.functions import scores
from foliary.functions.text import first_errors
from foliary.operators.corpus import seeded_rank, similarity_histogram
from foliary.operators.ranges import coalesce_ranges, greedy_groups, pages_in_ranges, split_ranges, stitch_bodies
from foliary.sources.markdown import quality_metrics

#: Repairs the pages start..end of a document: one text per page, one text for all, or an error.
Engine = Callable[[bytes, int, int, bool], list[str]]


def signal_columns() -> dict[str, Column]:
    """Signals of page rows (text, images, has_widgets, xs)."""
    t = F.col("text")
    return {
        "char_density": scores.char_density(t, F.col("images")),
        "non_ascii_ratio": scores.non_ascii_ratio(t),
        "long_unbroken_line": scores.long_unbroken_line(t),
        "column_gap": scores.column_gap(t),
        "table_char_density": scores.table_char_density(t),
        "image_heavy": scores.image_heavy(F.col("images")),
        "form_fields": scores.form_fields(F.col("has_widgets")),
        "layout_complexity": scores.layout_complexity(t, F.col("xs")),
    }


def score_pages(pages: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """Pages with their signals, aggregate, needs_repair and reason."""
    named = pages.withColumns({n: s.cast("double") for n, s in signal_columns().items()})
    return named.withColumn("s", scores.page_score({n: F.col(n) for n in scores.SIGNAL_WEIGHTS}, weights)).select("*", "s.*").drop("s")


def pre_signals() -> dict[str, Column]:
    """Signals of pages before any text is extracted (images, has_widgets, xs, fonts, ys)."""
    return {
        "image_heavy": scores.image_heavy(F.col("images")), "form_fields": scores.form_fields(F.col("has_widgets")), "layout_complexity": scores.layout_complexity(F.lit(""), F.col("xs")),
        "font_diversity": scores.font_diversity(F.col("fonts")), "text_flow_consistency": scores.text_flow_consistency(F.col("ys")),
    }


def pre_triage(pages: DataFrame, weights: dict[str, float] | None = None) -> tuple[DataFrame, DataFrame]:
    """(pages to extract cheaply and score, pages that go to the expensive engine at once). Two filters, so the second kind is never extracted."""
    told = pages.withColumn("pre", scores.pre_score(pre_signals(), weights))
    return told.where("pre.classification <> 'expensive'"), told.where("pre.classification = 'expensive'")


def triage(pages: DataFrame, files: DataFrame, engine: Engine | None, buffer: int = 1, merge_gap: int = 2, weights: dict[str, float] | None = None, budget: Column | None = None) -> DataFrame:
    """(doc_id, page_index, text, engine, aggregate, reason) of every page.

    ``pages`` is (doc_id, page_index, total_pages, text, images, has_widgets,
    xs), ``files`` (doc_id, content). Weak ranges go to ``engine``; a range it
    fails on keeps its cheap text. Without an engine, or where ``budget`` is
    false, nothing is repaired. Only files with a weak range are moved.
    """
    return _repaired(score_pages(pages, weights), files, engine, buffer, merge_gap, budget)


def _repaired(scored: DataFrame, files: DataFrame, engine: Engine | None, buffer: int, merge_gap: int, budget: Column | None) -> DataFrame:
    weak = scored.where("needs_repair") if budget is None else scored.where(F.col("needs_repair") & budget)
    ranges = coalesce_ranges(weak.select("doc_id", "page_index", "total_pages"), buffer, merge_gap)
    placed = pages_in_ranges(scored, ranges)
    if engine is None:
        return placed.select("doc_id", "page_index", "text", F.lit("heuristic").alias("engine"), "aggregate", "reason")
    asked = placed.where("range_start is not null").groupBy("doc_id", "range_start", "range_end").agg(F.bool_or(scores.needs_ocr(F.col("text"), F.col("images"))).alias("ocr"))

    def repair(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                n = r.range_end - r.range_start + 1
                try:
                    texts = engine(bytes(r.content), int(r.range_start), int(r.range_end), bool(r.ocr))
                except Exception:
                    continue
                if len(texts) == n:
                    out += [(r.doc_id, r.range_start + i, t, "layout") for i, t in enumerate(texts)]
                elif texts:
                    label = "layout-range" if len(texts) == 1 else "layout-collapsed"
                    out += [(r.doc_id, r.range_start + i, "\n\n".join(texts) if not i else "", label) for i in range(n)]
            yield pd.DataFrame(out, columns=["doc_id", "page_index", "better", "how"])

    kind = files.schema["doc_id"].dataType.simpleString()
    mended = asked.join(files.select("doc_id", "content"), "doc_id").mapInPandas(repair, f"doc_id {kind}, page_index int, better string, how string")
    return placed.join(mended, ["doc_id", "page_index"], "left").select("doc_id", "page_index", F.coalesce("better", "text").alias("text"), F.coalesce("how", F.lit("heuristic")).alias("engine"), "aggregate", "reason")


def triage_with_pre_score(pages: DataFrame, files: DataFrame, engine: Engine, buffer: int = 1, merge_gap: int = 2) -> DataFrame:
    """:func:`triage` in which pages that the score before extraction calls expensive are weak at once: their text is neither read nor scored.

    ``pages`` also has ``fonts`` and ``ys``.
    """
    cheap, costly = pre_triage(pages)
    scored = score_pages(cheap).select("doc_id", "page_index", "total_pages", "text", "images", "aggregate", "needs_repair", "reason")
    known = costly.select("doc_id", "page_index", "total_pages", F.lit("").alias("text"), "images", F.col("pre.aggregate").alias("aggregate"), F.lit(True).alias("needs_repair"), F.concat(F.lit("pre:"), F.col("pre.reason")).alias("reason"))
    return _repaired(scored.unionByName(known), files, engine, buffer, merge_gap, None)


def triage_report(pages: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """The report of a calibration run, as texts: page, signals, score, and quality of the cheap text. Nothing is repaired."""
    bound_batches(pages.sparkSession)
    four = lambda c: F.format_string("%.4f", F.col(c))
    scored = score_pages(pages, weights).withColumn("qm", quality_metrics("text"))
    metrics = [F.col("qm.parse_ok").cast("int").alias("qm_parse_ok"), *[F.col(f"qm.{n}").alias(f"qm_{n}") for n in ("heading_count", "section_count", "table_count", "table_cell_count")], F.format_string("%.3f", "qm.structural_density_per_1k").alias("qm_structural_density_per_1k"), F.col("qm.median_section_chars").alias("qm_median_section_chars")]
    return scored.select("doc_id", "page_index", *[four(n).alias(n) for n in scores.SIGNAL_WEIGHTS], four("aggregate").alias("aggregate"), F.col("needs_repair").cast("int").alias("needs_repair"), "reason", *metrics)


def pre_score_report(pages: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """The report of the score before extraction, as texts."""
    three = lambda c: F.format_string("%.3f", c)
    signals = pre_signals()
    named = pages.withColumns({n: s.cast("double") for n, s in signals.items()}).withColumn("pre", scores.pre_score({n: F.col(n) for n in signals}, weights))
    return named.select("doc_id", "page_index", *[three(F.col(n)).alias(n) for n in signals], three(F.col("pre.aggregate")).alias("aggregate"), F.col("pre.classification").alias("classification"), F.col("pre.reason").alias("reason"))


def engine_attribution(result: DataFrame) -> DataFrame:
    """Repaired pages that hold text, those left empty because their range came as one text, and characters, per document."""
    repaired, said = F.col("engine") != "heuristic", F.col("text") != ""
    return result.groupBy("doc_id").agg(F.count_if(repaired & said).alias("content_pages"), F.count_if(repaired & ~said).alias("placeholder_pages"), F.sum(F.when(repaired, F.length("text")).otherwise(0)).alias("repaired_chars"))


def triage_statistics(result: DataFrame) -> DataFrame:
    """Pages in all, repaired and kept, and characters by engine, per document."""
    repaired = F.col("engine") != "heuristic"
    return result.groupBy("doc_id").agg(F.count("*").alias("pages_total"), F.count_if(repaired).alias("pages_repaired"), F.count_if(~repaired).alias("pages_kept"), F.count_if(F.trim("text") == "").alias("pages_empty"), F.sum(F.when(repaired, F.length("text")).otherwise(0)).alias("repaired_chars"))


def qa_tripwire(result: DataFrame, pages: DataFrame, engine_text: DataFrame, rate: float, most: int, seed: int = 42) -> DataFrame:
    """Similarity counts of a seeded sample of kept pages against what the engine makes of them (doc_id, page_index, engine_text)."""
    kept = result.where("engine = 'heuristic'").select("doc_id", "page_index", "text")
    n = min(most, int(kept.count() * rate) or 1)
    key = F.concat_ws(":", F.col("doc_id").cast("string"), F.col("page_index").cast("string"))
    sample = kept.orderBy(seeded_rank(seed, key), "doc_id", "page_index").limit(n)
    return similarity_histogram(sample.join(engine_text, ["doc_id", "page_index"]).withColumn("similarity", scores.jaccard_words(F.col("text"), F.col("engine_text"))))


#: What a worker's exit says, and the render scales of a retry.
EXITS = {"ok": 0, "usage": 2, "missing": 3, "unavailable": 4, "engine": 5, "other": 6}
SCALES = (2.0, 1.5, 1.0)


def exit_code(error: BaseException | None) -> int:
    """The exit code of what happened: no input, a library that is not there, an engine that raised, or anything else."""
    kinds = ((FileNotFoundError, "missing"), (ImportError, "unavailable"), (Exception, "engine"), (BaseException, "other"))
    return EXITS["ok"] if error is None else next(EXITS[name] for kind, name in kinds if isinstance(error, kind))


def attempt(engine: Callable, content: bytes, part: dict, ocr: bool, scale: float | None) -> dict:
    """One chunk's envelope: its texts, or what went wrong; a chunk that fails never takes the others with it."""
    more = {} if scale is None else {"scale": scale}
    try:
        pages = list(engine(content, part["start"], part["stop"] - 1, ocr, **more))
        return {"chunk": part["chunk"], "text": "\n\n".join(pages), "error": None, "code": EXITS["ok"]}
    except Exception as e:
        return {"chunk": part["chunk"], "text": None, "error": repr(e), "code": exit_code(e)}


def dispatch(engine: Callable, content: bytes, parts: list[dict], ocr: bool, cap: int, scales: tuple[float, ...]) -> list[dict]:
    """Envelopes of a group. What fails is tried again in groups of half the pages down to one chunk, then at the next lower scale, then conceded."""
    done, todo = [], [(parts, cap, 0)]
    while todo:
        group, cap, step = todo.pop(0)
        found = [attempt(engine, content, p, ocr, scales[step] if ocr and scales and step else None) for p in group]
        failed = [p for p, e in zip(group, found, strict=True) if e["error"]]
        done += [e for e in found if not e["error"]]
        if not failed:
            continue
        if len(failed) > 1 and cap > 1:
            half = max(1, min(cap // 2, len(failed) - 1))
            todo += [(failed[i : i + half], half, step) for i in range(0, len(failed), half)]
        elif ocr and step + 1 < len(scales):
            todo.append((failed, cap, step + 1))
        else:
            done += [e for e in found if e["error"]]
    return done


def chunked(files: DataFrame, engine: Engine, max_pages: int = 50, overlap: int = 2, group_pages: int = 40, ocr_pages: int = 8, scales: tuple[float, ...] = ()) -> DataFrame:
    """(doc_id, body, error, code): whole documents through the expensive engine in overlapping chunks, packed to groups, with adaptive retries.

    ``files`` is (doc_id, content, total_pages, needs_ocr). With ``scales``
    (SCALES) the engine takes a ``scale`` and chunks to be recognised are tried
    again at lower ones. What still fails is left out and named in ``error``
    (three at most), ``code`` is the largest exit code. Groups are spread over
    the cluster.
    """
    chunks = files.select("doc_id", split_ranges(F.col("total_pages"), max_pages, overlap).alias("chunks"), "needs_ocr")
    sizes = F.transform("chunks", lambda c: c["stop"] - c["start"])
    grouped = chunks.withColumn("groups", greedy_groups(sizes, group_pages, F.transform("chunks", lambda _: F.col("needs_ocr")), ocr_pages))
    work = grouped.select("doc_id", "needs_ocr", F.explode(F.arrays_zip("chunks", "groups")).alias("z")).select("doc_id", "needs_ocr", F.col("z.groups").alias("pack"), "z.chunks.*")
    packs = work.groupBy("doc_id", "needs_ocr", "pack").agg(F.array_sort(F.collect_list(F.struct("chunk", "start", "stop"))).alias("parts"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [{"doc_id": r.doc_id, **e} for r in batch.itertuples(index=False) for e in dispatch(engine, bytes(r.content), [dict(p) for p in r.parts], bool(r.needs_ocr), ocr_pages if r.needs_ocr else group_pages, scales)]
            yield pd.DataFrame(out, columns=["doc_id", "chunk", "text", "error", "code"]).astype(object).where(lambda d: d.notna(), None)

    kind = files.schema["doc_id"].dataType.simpleString()
    done = packs.join(files.select("doc_id", "content"), "doc_id").mapInPandas(run, f"doc_id {kind}, chunk int, text string, error string, code int")
    bodies = F.transform(F.array_sort(F.collect_list(F.when(F.col("text").isNotNull(), F.struct("chunk", "text")))), lambda x: x["text"])
    return done.groupBy("doc_id").agg(stitch_bodies(bodies).alias("body"), first_errors(F.array_sort(F.collect_list("error"))).alias("error"), F.max("code").alias("code"))

"""Page signals, scores, resource budgets and study verdicts as column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliary.functions.text import LINE_END, let, strip

#: Weights and thresholds of the page score and of the score before extraction.
SIGNAL_WEIGHTS = {
    "char_density": 1.0, "non_ascii_ratio": 1.2, "long_unbroken_line": 0.8, "column_gap": 1.0,
    "table_char_density": 1.0, "image_heavy": 0.9, "form_fields": 1.2, "layout_complexity": 1.1,
}
PRE_WEIGHTS = {"image_heavy": 0.9, "form_fields": 1.2, "layout_complexity": 1.1, "font_diversity": 1.0, "text_flow_consistency": 1.0}
HARD, AGGREGATE, TOLD = 0.7, 0.5, 0.3
PRE_EXPENSIVE, PRE_CHEAP = 0.7, 0.2
#: The memory model of optical recognition and its caps.
OCR_BASE_MB, OCR_PER_MEGAPIXEL, OCR_PAGE_MB, OCR_SAFE, OCR_SCALE, OCR_FIXED_CAP = 1412.84, 15.4942, 207.0, 0.6, 2.0, 8


def weights_with(defaults: Mapping[str, float], overrides: Mapping[str, float] | None) -> dict[str, float]:
    """Defaults overlaid with numeric, non-negative overrides."""
    out = dict(defaults)
    for name, value in (overrides or {}).items():
        if isinstance(value, bool) or not isinstance(value, int | float) or value < 0:
            raise ValueError(f"weight of {name!r} must be a number of 0 or more")
        out[name] = float(value)
    return out


def char_density(text: Column, images: Column) -> Column:
    sparse = let(F.length(strip(text)), lambda n: F.when(n >= 200, 0.0).otherwise(1.0 - n / 200.0))
    return F.when(F.coalesce(images, F.lit(0)) == 0, 0.0).otherwise(sparse)


def needs_ocr(text: Column, images: Column) -> Column:
    return char_density(text, images) > 0


def _share(part: Column, text: Column, of) -> Column:
    """``of`` the share that a count has of a text's length, the count taken once; 0 of the empty text."""
    return F.when(F.length(text) == 0, 0.0).otherwise(let(part / F.length(text), of))


def non_ascii_ratio(text: Column) -> Column:
    """Share of unassigned, private or unprintable characters beyond a twentieth, over 0.15."""
    odd = F.length(F.regexp_replace(F.translate(text, "\n\r\t ", ""), r"[^\p{C}\p{Zl}\p{Zp}\p{Zs}]+", ""))
    return _share(odd, text, lambda r: F.when(r <= 0.05, 0.0).otherwise(F.least(F.lit(1.0), (r - 0.05) / 0.15)))


def long_unbroken_line(text: Column) -> Column:
    few = lambda l: F.size(F.filter(F.split(l, r"\s+"), lambda w: w != "")) <= 20
    # Most texts have no such line: a text shorter than one is not even cut into lines.
    return F.when(F.length(text) < 200, 0.0).when(F.exists(F.split(text, LINE_END), lambda l: (F.length(l) >= 200) & few(l)), 1.0).otherwise(0.0)


def column_gap(text: Column) -> Column:
    kept = F.filter(F.split(text, LINE_END), lambda l: strip(l) != "")
    gapped = lambda ls: F.size(F.filter(ls, lambda l: l.contains("      ") & l.rlike(r"\S {6,}\S"))) / F.size(ls)
    told = let(kept, lambda ls: let(F.when(F.size(ls) > 0, gapped(ls)).otherwise(0.0), lambda r: F.when(r < 0.3, 0.0).otherwise(F.least(F.lit(1.0), r / 0.5))))
    return F.when(text.contains("      "), told).otherwise(0.0)


def table_char_density(text: Column) -> Column:
    lines_ = F.length(text) - F.length(F.translate(text, "|│─━═", ""))
    return _share(lines_, text, lambda d: F.when(d < 0.02, 0.0).otherwise(F.least(F.lit(1.0), (d - 0.02) / 0.04)))


def image_heavy(images: Column) -> Column:
    return F.when(F.coalesce(images, F.lit(0)) >= 3, 1.0).otherwise(0.0)


def form_fields(has_widgets: Column) -> Column:
    return F.when(F.coalesce(has_widgets, F.lit(False)), 1.0).otherwise(0.0)


def font_diversity(fonts: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.coalesce(fonts, F.lit(0)) - 2) / 3.0))


def x_clusters(xs: Column, gap: float = 10.0) -> Column:
    """Clusters of sorted positions: a new one begins more than ``gap`` right of the start of the one before."""
    start = F.struct(F.lit(0).alias("n"), F.lit(None).cast("double").alias("first"))

    def step(acc: Column, x: Column) -> Column:
        new = acc["first"].isNull() | (x - acc["first"] > gap)
        return F.struct((acc["n"] + F.when(new, 1).otherwise(0)).alias("n"), F.when(new, x).otherwise(acc["first"]).alias("first"))

    return F.aggregate(F.array_sort(xs), start, step, lambda acc: acc["n"])


def layout_complexity(text: Column, xs: Column) -> Column:
    count = F.greatest(F.lit(1), F.size(F.filter(F.split(text, LINE_END), lambda l: strip(l) != "")))
    # A line is there at least, so with one cluster or none the lines need not be counted.
    return let(F.coalesce(x_clusters(xs), F.lit(0)), lambda n: F.when(n <= 1, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), (n - count) / 4.0))))


def text_flow_consistency(ys: Column) -> Column:
    """Coefficient of variation of the gaps between positions that follow one another, at most 1; 0 of fewer than three."""
    gaps = F.transform(F.slice(ys, F.lit(2), F.greatest(F.size(ys) - 1, F.lit(0))), lambda y, i: F.abs(y - F.get(ys, i)))

    def variation(gap: Column, mean: Column) -> Column:
        var = F.aggregate(gap, F.lit(0.0), lambda a, g: a + (g - mean) * (g - mean)) / F.size(gap)
        return F.when(mean == 0, 0.0).otherwise(F.least(F.lit(1.0), F.sqrt(var) / mean))

    cv = let(gaps, lambda gap: let(F.aggregate(gap, F.lit(0.0), lambda a, g: a + g) / F.size(gap), lambda mean: variation(gap, mean)))
    return F.when(F.coalesce(F.size(ys), F.lit(0)) < 3, 0.0).otherwise(cv)


def _weighted(signals: Mapping[str, Column], weights: Mapping[str, float]) -> dict[str, Column]:
    return {name: signals[name] * F.lit(float(weights.get(name, 0.0))) for name in signals}


def _mean(weighted: Mapping[str, Column], weights: Mapping[str, float]) -> Column:
    total = sum(weights.get(n, 0.0) for n in weighted)
    whole = F.lit(0.0)
    for x in weighted.values():
        whole = whole + x
    return whole / F.lit(total) if total > 0 else F.lit(0.0)


def _named(weighted: Mapping[str, Column], over: float) -> Column:
    return F.concat_ws(",", *[F.when(x > over, F.lit(n)) for n, x in weighted.items()])


def page_score(signals: Mapping[str, Column], overrides: Mapping[str, float] | None = None) -> Column:
    """struct<aggregate, needs_repair, reason> of a page's signals."""
    weights = weights_with(SIGNAL_WEIGHTS, overrides)
    w = _weighted(signals, weights)
    mean = _mean(w, weights)
    hard = F.greatest(*w.values()) >= HARD
    flagged = hard | (mean >= AGGREGATE)
    told = _named(w, TOLD)
    return F.struct(mean.alias("aggregate"), flagged.alias("needs_repair"), F.when(~flagged, "ok").when(told == "", "aggregate").otherwise(told).alias("reason"))


def pre_score(signals: Mapping[str, Column], overrides: Mapping[str, float] | None = None) -> Column:
    """struct<aggregate, classification, reason> of a page before any text is extracted."""
    weights = weights_with(PRE_WEIGHTS, overrides)
    w = _weighted(signals, weights)
    mean = _mean(w, weights)
    told = _named(w, TOLD)
    kind = F.when(mean >= PRE_EXPENSIVE, "expensive").when(mean <= PRE_CHEAP, "cheap").otherwise("uncertain")
    reason = F.when(mean >= PRE_EXPENSIVE, F.when(told == "", "aggregate").otherwise(told)).when(mean <= PRE_CHEAP, "clean").otherwise("borderline")
    return F.struct(mean.alias("aggregate"), kind.alias("classification"), reason.alias("reason"))


def word_tokens(text: Column) -> Column:
    """The distinct lower-case word tokens."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"(?U)\w+"), F.lit(0)))


def jaccard_tokens(x: Column, y: Column) -> Column:
    """Shared share of two sets of tokens; 1 of two empty ones, 0 of one."""
    both = F.size(x) + F.size(y)
    shared = let(F.size(F.array_intersect(x, y)), lambda n: n / (both - n))
    return F.when(both == 0, 1.0).when((F.size(x) == 0) | (F.size(y) == 0), 0.0).otherwise(shared)


def jaccard_words(a: Column, b: Column) -> Column:
    return let(word_tokens(a), lambda x: let(word_tokens(b), lambda y: jaccard_tokens(x, y)))


# --- resource budgets -------------------------------------------------------------------


def page_megapixels(width_pt: Column, height_pt: Column) -> Column:
    return width_pt * height_pt / 1e6


def predicted_peak_mb(megapixels: Column, scale: Column, pages: Column) -> Column:
    return F.lit(OCR_BASE_MB) + F.lit(OCR_PER_MEGAPIXEL) * megapixels * scale * scale * pages


def pages_per_group(available_mb: Column, megapixels: Column, scale: float = OCR_SCALE, safe: float = OCR_SAFE) -> Column:
    """Pages that the safe share of memory holds, by area and by a floor per page; at least one."""
    usable = available_mb * safe - OCR_BASE_MB
    by_floor = F.floor(usable / OCR_PAGE_MB)
    by_area = F.floor(usable / (F.lit(OCR_PER_MEGAPIXEL) * megapixels * scale * scale))
    return F.when(usable <= 0, 1).otherwise(F.greatest(F.lit(1), F.least(F.when(megapixels > 0, by_area).otherwise(by_floor), by_floor))).cast("int")


def resolved_cap(available_gb: Column, megapixels: Column) -> Column:
    """Pages per group from memory and the largest page; the fixed cap where either is unknown."""
    known = F.coalesce((available_gb > 0) & (megapixels > 0), F.lit(False))
    return F.when(known, pages_per_group(available_gb * 1000.0, megapixels)).otherwise(OCR_FIXED_CAP).cast("int")


def smaller_cap(cap: Column, derived: Column) -> Column:
    """The cap of a retry: what is derived or half, always less, never under one."""
    return F.greatest(F.lit(1), F.least(cap - 1, F.coalesce(derived, F.floor(cap / 2)))).cast("int")


def recovered_scale(scales: Column, megapixels: Column, available_mb: Column, pages: Column, safe: float = OCR_SAFE) -> Column:
    """The largest scale at which the pages fit the safe share of memory; null if none does."""
    return F.array_max(F.filter(scales, lambda s: predicted_peak_mb(megapixels, s, pages) <= available_mb * safe))


def host_budget(available_gb: Column, cpus: Column, pressed: Column, gpu_gb: Column) -> Column:
    """struct<max_pages, max_mb, serialize, workers, threads> of a host by memory tier, or by its accelerator; under pressure half the pages, one at a time."""
    tier = lambda *v: F.when(available_gb < 4, v[0]).when(available_gb < 8, v[1]).when(available_gb < 16, v[2]).when(available_gb < 32, v[3]).otherwise(v[4])
    gpu = gpu_gb.isNotNull()
    many = F.greatest(F.floor(cpus / 2), F.lit(1))
    quarter = F.greatest(F.lit(2), F.floor(cpus / 4))
    pages = F.when(gpu, F.least(F.lit(200), F.floor(gpu_gb * 25))).otherwise(tier(0, 25, 50, 75, 100))
    return F.struct(
        F.when(pressed & (pages > 1), F.greatest(F.floor(pages / 2), F.lit(1))).otherwise(pages).cast("int").alias("max_pages"),
        F.when(gpu, 80).otherwise(tier(0, 10, 20, 30, 40)).cast("int").alias("max_mb"),
        (pressed | (~gpu & (available_gb < 16))).alias("serialize"),
        F.when(gpu, 1).otherwise(tier(1, 1, 1, 2, F.least(many, F.lit(4)))).cast("int").alias("workers"),
        F.when(gpu, quarter).otherwise(tier(1, 1, 2, 2, quarter)).cast("int").alias("threads"),
    )


def expensive_verdict(budget: Column, size_mb: Column, pages: Column) -> Column:
    """"ok", or the first reason against the expensive engine: memory, size, pages. An unknown page count passes."""
    none = (budget["max_pages"] <= 0) | (budget["max_mb"] <= 0)
    return F.when(none, "insufficient_ram").when(size_mb > budget["max_mb"], "file_too_large").when(pages > budget["max_pages"], "page_count_too_high").otherwise("ok")


def engine_choice(requested: Column, layout_available: Column, verdict: Column) -> Column:
    """struct<engine, reason>; null of an engine that is not known. A request by name is kept, "auto" takes what is there and allowed."""
    known = requested.isin("auto", "layout", "heuristic")
    named = F.struct(requested.alias("engine"), F.lit("explicit_request").alias("reason"))
    auto = F.when(~layout_available, F.struct(F.lit("heuristic").alias("engine"), F.lit("engine_unavailable").alias("reason"))).otherwise(F.struct(F.when(verdict == "ok", "layout").otherwise("heuristic").alias("engine"), verdict.alias("reason")))
    return F.when(known, F.when(requested != "auto", named).otherwise(auto))


def percent_change(value: Column, base: Column) -> Column:
    return F.when(base != 0, (value - base) / base * 100)


def stability_tier(size_mb: Column) -> Column:
    return F.when(size_mb <= 10, "stable").when(size_mb <= 30, "experimental").otherwise("unsupported")


def reader_verdict(exists: Column, size: Column, mime: Column, trusted: Column, allowed: tuple[str, ...], most: int = 50 << 20) -> Column:
    """"ok", or why a file is not read: missing, too large, type, or untrusted."""
    risky = mime.isin("application/pdf", "application/vnd.openxmlformats-officedocument.wordprocessingml.document")
    return F.when(~exists, "missing").when(size > most, "size").when(F.coalesce(~mime.isin(*allowed), F.lit(False)), "type").when(F.coalesce(risky, F.lit(False)) & ~trusted, "untrusted").otherwise("ok")


def engine_envelope(raw: Column) -> Column:
    """struct<text, pages> of an engine's answer: its fields, or the whole answer as one page where it is no such object."""
    e = F.from_json(raw, "text string, pages array<string>")
    good = F.coalesce(e["text"].isNotNull() & e["pages"].isNotNull() & ~F.exists(e["pages"], lambda p: p.isNull()), F.lit(False))
    return F.struct(F.when(good, e["text"]).otherwise(raw).alias("text"), F.when(good, e["pages"]).otherwise(F.array(raw)).alias("pages"))


def placeholder_title(title: Column) -> Column:
    """Titles that say nothing: empty, index, untitled, page numbers."""
    return F.lower(F.trim(F.coalesce(title, F.lit("")))).rlike(r"^(?:|index|untitled|document|page(?: \d+)?|toc|readme|\d+)$")


def usable_lead(paragraph: Column, least: int = 40, most: int = 2000) -> Column:
    return F.length(F.trim(paragraph)).between(least, most)

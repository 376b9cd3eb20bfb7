"""Markdown text as column expressions: lines, fences, headings, anchors, binning.

A body is held as an array of lines; state along lines comes from the short
arrays of marker positions (fences, headings), so no expression depends on the
square of a body's length and nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Line ends as Unicode names them, for operators that break at all of them.
LINE_END = "\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"
#: White space that stripping takes away.
BLANK = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
HEADING = r"^(#{1,6})\s+(.+?)\s*$"
ANCHOR_HEADING = r"^#{1,3}\s+\S"
ANCHOR_FENCE = r"^\s{0,3}(?:```|~~~)"
MAX_CHARS = 12_000


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once: a lambda evaluates what it captures anew for each element, but not its own variable."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(x: Column) -> Column:
    return F.btrim(x, F.lit(BLANK))


def lines(body: Column) -> Column:
    return F.split(body, "\n")


def split_lines(body: Column) -> Column:
    """Lines at every Unicode line end, without an empty last one."""
    parts = F.split(body, LINE_END)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)


def positions(ls: Column, test) -> Column:
    """0-based numbers of the lines that pass."""
    return F.filter(F.transform(ls, lambda l, i: F.when(test(l), i)), lambda p: p.isNotNull())


def headings(body: Column) -> Column:
    """array<struct<line, level, text>> of ATX headings; fences are not looked at."""
    found = F.transform(split_lines(body), lambda l, i: F.when(l.rlike(HEADING), F.struct(i.alias("line"), F.length(F.regexp_extract(l, HEADING, 1)).alias("level"), F.regexp_extract(l, HEADING, 2).alias("text"))))
    return F.filter(found, lambda h: h.isNotNull())


def fence_spans(ls: Column) -> Column:
    """array<struct<start, stop>> of fenced lines: a fence opens, the next of the same sign closes, an open one runs to the end."""
    marked = F.filter(F.transform(ls, lambda l, i: F.when(l.rlike("^(```+|~~~+)"), F.struct(i.alias("at"), F.substring(l, 1, 1).alias("sign")))), lambda m: m.isNotNull())
    none = F.lit(None).cast("int")
    start = F.struct(F.array().cast("array<struct<start:int,stop:int>>").alias("spans"), none.alias("open"), F.lit("").alias("sign"))

    def step(acc: Column, m: Column) -> Column:
        closes = acc["open"].isNotNull() & (acc["sign"] == m["sign"])
        opens = acc["open"].isNull()
        return F.struct(
            F.when(closes, F.array_append(acc["spans"], F.struct(acc["open"].alias("start"), m["at"].alias("stop")))).otherwise(acc["spans"]).alias("spans"),
            F.when(opens, m["at"]).when(closes, none).otherwise(acc["open"]).alias("open"),
            F.when(opens, m["sign"]).otherwise(acc["sign"]).alias("sign"),
        )

    def finish(acc: Column) -> Column:
        return F.when(acc["open"].isNull(), acc["spans"]).otherwise(F.array_append(acc["spans"], F.struct(acc["open"].alias("start"), F.lit(2147483647).alias("stop"))))

    return F.aggregate(marked, start, step, finish)


def first_heading_lines(body: Column) -> Column:
    """struct<h1, h2, h3>: the first line of each level outside fences, null if there is none."""

    def first(ls: Column, spans: Column, level: int) -> Column:
        found = positions(ls, lambda l: l.rlike(f"^{'#' * level} [^\\n]+$"))
        return F.array_min(F.filter(found, lambda p: ~F.exists(spans, lambda s: (s["start"] <= p) & (p <= s["stop"])))).alias(f"h{level}")

    return let(lines(body), lambda ls: let(fence_spans(ls), lambda spans: F.struct(*[first(ls, spans, n) for n in (1, 2, 3)])))


def heading_verdict(body: Column) -> Column:
    """"skipped" (no H1, no H2, or an H3 before the first H2), "fail" (an H2 or H3 before its parent) or "pass"."""

    def verdict(f: Column) -> Column:
        skip = f["h1"].isNull() | f["h2"].isNull() | (f["h3"] < f["h2"])
        return F.when(F.coalesce(skip, F.lit(False)), "skipped").when((f["h2"] < f["h1"]) | F.coalesce(f["h3"] < f["h1"], F.lit(False)), "fail").otherwise("pass")

    return let(first_heading_lines(body), verdict)


def lint(body: Column, doc_type: Column) -> Column:
    """Errors of a body: headings deeper than three, required sections that are missing."""
    hs = headings(body)
    sections = F.transform(F.filter(hs, lambda h: h["level"] == 2), lambda h: h["text"])
    required = F.when(doc_type == "adr", F.array(F.lit("Decision"))).otherwise(F.array().cast("array<string>"))
    deep = F.when(F.exists(hs, lambda h: h["level"] > 3), F.array(F.lit("Heading depth exceeded schema limits"))).otherwise(F.array().cast("array<string>"))
    return F.concat(deep, F.transform(F.array_except(required, sections), lambda s: F.concat(F.lit("Missing required section: "), s)))


def rewritten(ls: Column, marks: Column, at, head) -> Column:
    """Lines joined again, each marked one (``at`` gives its place) as ``head(mark, k)`` says, null for none.

    The cost grows with the lines, not with lines times marks.
    """
    rest = lambda m, k: F.slice(ls, at(m) + 2, F.coalesce(at(F.get(marks, k + 1)), F.size(ls)) - at(m) - 1)
    there = lambda m, k: F.filter(F.concat(F.array(head(m, k)), rest(m, k)), lambda l: l.isNotNull())
    pieces = F.transform(marks, lambda m, k: let(there(m, k), lambda ls: F.when(F.size(ls) > 0, F.array_join(ls, "\n"))))
    lead = F.slice(ls, F.lit(1), F.coalesce(at(F.get(marks, F.lit(0))), F.size(ls)))
    return F.array_join(F.concat(lead, pieces), "\n")


def chunk_anchors(body: Column) -> Column:
    """A numbered anchor line before each H1 to H3 outside fences; any fence line toggles."""
    head = lambda ls: lambda p, k: F.concat(F.format_string('<a id="chunk-%04d"></a>\n', k + 1), F.get(ls, p))
    return let(lines(body), lambda ls: let(_anchored(ls), lambda heads: rewritten(ls, heads, lambda p: p, head(ls))))


def _anchored(ls: Column) -> Column:
    """Lines of headings that get an anchor.

    Heads and fences are sorted together: the k-th head at place i of both has
    i - k fences before it.
    """
    marks = F.filter(F.transform(ls, lambda l, i: F.when(l.rlike(ANCHOR_FENCE), F.struct(i.alias("at"), F.lit(False).alias("head"))).when(l.rlike(ANCHOR_HEADING), F.struct(i.alias("at"), F.lit(True).alias("head")))), lambda m: m.isNotNull())
    heads = let(marks, lambda ms: F.filter(F.transform(ms, lambda m, i: F.when(m["head"], F.struct(m["at"].alias("at"), i.alias("place")))), lambda h: h.isNotNull()))
    return let(heads, lambda hs: F.filter(F.transform(hs, lambda h, k: F.when((h["place"] - k) % 2 == 0, h["at"])), lambda p: p.isNotNull()))


def chunk_count(body: Column) -> Column:
    return F.size(let(lines(body), _anchored))


def normal_levels(levels: Column) -> Column:
    """Shifted so that the least is 1, then none more than one below its predecessor.

    Closed form of that recurrence: the k-th level is k + min(0, min over j <= k of (level_j - j)).
    Levels lie between 1 and 6, so that minimum is among the last six.
    """
    gaps = let(F.array_min(levels), lambda least: F.transform(levels, lambda l, j: l - least - j))
    last_six = lambda gap, k: F.slice(gap, F.greatest(k - 4, F.lit(1)), F.least(k + 1, F.lit(6)))
    return let(gaps, lambda gap: F.transform(gap, lambda _, k: k + 1 + F.least(F.lit(0), F.array_min(last_six(gap, k)))))


def normalize_headings(body: Column) -> Column:
    """The body with its ATX heading levels made gapless."""
    level = lambda l: F.length(F.regexp_extract(l, HEADING, 1))
    found = lambda ls: F.filter(F.transform(ls, lambda l, i: F.when(l.rlike(HEADING), F.struct(i.alias("at"), level(l).alias("level"), strip(F.regexp_extract(l, HEADING, 2)).alias("text")))), lambda h: h.isNotNull())

    def written(ls: Column, heads: Column, wanted: Column) -> Column:
        head = lambda h, k: F.concat(F.repeat(F.lit("#"), F.get(wanted, k).cast("int")), F.lit(" "), h["text"])
        return rewritten(ls, heads, lambda h: h["at"], head)

    return let(lines(body), lambda ls: let(found(ls), lambda heads: let(normal_levels(F.transform(heads, lambda h: h["level"])), lambda wanted: written(ls, heads, wanted))))


def shift_headings(body: Column, by: int) -> Column:
    """All headings ``by`` levels deeper, at most six."""
    form = r"^(#{1,6})(\s+.+)$"
    out = F.transform(lines(body), lambda l: F.when(l.rlike(form), F.concat(F.repeat(F.lit("#"), F.least(F.length(F.regexp_extract(l, form, 1)) + by, F.lit(6))), F.regexp_extract(l, form, 2))).otherwise(l))
    return F.array_join(out, "\n")


def with_title_h1(body: Column, title: Column) -> Column:
    """A web body in heading order under its title: kept if its first heading is the title, else the title goes on top and the rest one level down."""

    def titled(normal: Column) -> Column:
        first = F.get(headings(normal), F.lit(0))["text"]
        same = F.coalesce(F.lower(strip(first)) == F.lower(strip(title)), F.lit(False))
        return F.when(normal == "", F.concat(F.lit("# "), title)).when(same, normal).otherwise(F.concat(F.lit("# "), title, F.lit("\n\n"), shift_headings(normal, 1)))

    return let(strip(normalize_headings(strip(body))), titled)


def section_title(body: Column) -> Column:
    """Text of the first H1 outside fences."""
    return strip(F.regexp_replace(F.get(lines(body), first_heading_lines(body)["h1"]), "^# +", ""))


def char_bins(text: Column, most: int = MAX_CHARS) -> Column:
    """Paragraphs (blank line between) packed in order into bins of at most ``most`` characters; a longer one stands alone; [""] if empty."""
    paragraphs = F.filter(F.transform(F.split(text, "\n\n"), strip), lambda p: p != "")
    start = F.struct(F.array().cast("array<string>").alias("bins"), F.lit("").alias("now"))

    def step(acc: Column, p: Column) -> Column:
        full = (acc["now"] != "") & (F.length(acc["now"]) + F.length(p) + 2 > most)
        return F.struct(
            F.when(full, F.array_append(acc["bins"], acc["now"])).otherwise(acc["bins"]).alias("bins"),
            F.when(full | (acc["now"] == ""), p).otherwise(F.concat(acc["now"], F.lit("\n\n"), p)).alias("now"),
        )

    return F.aggregate(paragraphs, start, step, lambda acc: F.array_append(acc["bins"], acc["now"]))


def _split_at(text: Column, level: int) -> Column:
    """Pieces that begin at headings of the level outside fences; the text before the first one comes first."""

    def cuts(ls: Column, spans: Column) -> Column:
        at = F.filter(positions(ls, lambda l: l.rlike(f"^ {{0,3}}#{{{level}}}(?:[ \\t]|$)")), lambda p: ~F.exists(spans, lambda s: (s["start"] <= p) & (p <= s["stop"])))
        return F.array_distinct(F.concat(F.array(F.lit(0)), at))

    def pieces(ls: Column, at: Column) -> Column:
        return F.transform(at, lambda c, k: F.array_join(F.slice(ls, c + 1, F.coalesce(F.get(at, k + 1), F.size(ls)) - c), "\n"))

    return let(lines(text), lambda ls: let(let(fence_spans(ls), lambda spans: cuts(ls, spans)), lambda at: pieces(ls, at)))


def segment(text: Column, most: int = MAX_CHARS) -> Column:
    """Parts of a body: at H1s; one that is too long at its H2s, or into bins if that does not do."""
    plain = F.regexp_replace(text, "\r\n?", "\n")

    def refine(part: Column) -> Column:
        sub = _split_at(part, 2)
        poor = (F.size(sub) <= 1) | F.exists(sub, lambda s: F.length(s) > most)
        return F.when(F.length(part) <= most, F.array(part)).when(poor, char_bins(part, most)).otherwise(sub)

    has_h1 = first_heading_lines(plain)["h1"].isNotNull()
    parts = F.when(has_h1, F.flatten(F.transform(_split_at(plain, 1), refine))).otherwise(char_bins(plain, most))
    kept = F.filter(F.transform(parts, strip), lambda p: p != "")
    return F.when(F.size(kept) == 0, F.array(F.lit(""))).otherwise(kept)


def fits_line_limit(text: Column, most: int = 4096) -> Column:
    return ~F.exists(lines(text), lambda l: F.length(l) > most)


def title_from_stem(rel_path: Column) -> Column:
    """File name without ending, "-" and "_" as spaces, words capitalised; "Document" if nothing is left."""
    stem = F.regexp_replace(F.regexp_extract(rel_path, "([^/]*)$", 1), r"\.[^.]+$", "")
    words = strip(F.translate(stem, "-_", "  "))
    return F.when(words == "", "Document").otherwise(F.initcap(words))


def clock(ms: Column) -> Column:
    """Milliseconds as mm:ss.mmm, minutes without bound."""
    return F.format_string("%02d:%02d.%03d", F.floor(ms / 60000).cast("bigint"), F.floor(ms % 60000 / 1000).cast("bigint"), (ms % 1000).cast("bigint"))


def clock_to_ms(stamp: Column) -> Column:
    """h:mm:ss.mmm or mm:ss.mmm in milliseconds; null if it is neither."""
    form = r"^(?:(\d+):)?(\d+):(\d+)\.(\d+)$"
    n = lambda i: F.coalesce(F.nullif(F.regexp_extract(stamp, form, i), F.lit("")).cast("bigint"), F.lit(0).cast("bigint"))
    ms = F.substring(F.rpad(F.regexp_extract(stamp, form, 4), 3, "0"), 1, 3).cast("bigint")
    return F.when(stamp.rlike(form), (n(1) * 3600 + n(2) * 60 + n(3)) * 1000 + ms)


def printable(text: Column) -> Column:
    """Unprintable characters as spaces."""
    return F.regexp_replace(text, r"[\p{C}\p{Zl}\p{Zp}]", " ")


def percent_done(done: Column, total: Column) -> Column:
    """Whole percent from 0 to 100; 100 of nothing to do, and not before all is done."""
    pct = F.greatest(F.lit(0), F.least(F.lit(100), F.bround(done * 100 / total)))
    return F.when(total <= 0, 100).when((done < total) & (pct >= 100), 99).otherwise(pct).cast("int")


def yaml_scalar(x: Column) -> Column:
    """A text value in double quotes with JSON escapes, or null."""
    return F.when(x.isNull(), "null").otherwise(F.regexp_extract(F.to_json(F.struct(x.alias("v"))), r"(?s)^\{\"v\":(.*)\}$", 1))


def first_errors(errors: Column, most: int = 3) -> Column:
    """The first errors of an array in one line."""
    return F.array_join(F.slice(F.filter(errors, lambda e: e.isNotNull()), 1, most), "; ")

"""Exact removal of long repeated byte strings over a whole corpus.

A byte goes if a string of ``length`` bytes that covers it starts at another
place too, in the same or another text.

1. *Anchors.* In every window of ``length`` bytes the least hash of its grams
   (256 bytes of 400; rightmost of equals) is the window's anchor. Equal windows
   have equal anchors at equal offsets, so only windows under one anchor hash
   need to be held against each other. Consecutive windows share an anchor;
   their bytes together are its context.
2. *Counts.* A first pass counts anchor hashes, nothing else. Those that occur
   twice are marked in a bitmap sized by their number, and a second pass
   describes only marked anchors (a false mark costs a row, never a result). Contexts that
   occur twice in whole repeat in all their windows. These are counts, combined
   before the shuffle, so exact copies and passages in a third of all rows are
   cheap.
3. *Suffixes.* What differs somewhere meets by anchor: the distinct contexts of
   anchors with two or more are laid end to end, a Burrows-Wheeler transform is
   made of them, and breadth-first backward extension of intervals derives the
   longest common prefixes by increasing value. It stops at ``length``: borders
   not reached by then belong to windows that repeat.
4. Anchors with more than ``HOT_CONTEXTS`` distinct contexts (the edge of a
   passage that very many texts share) are too many for one task; their windows
   are counted one by one by (anchor, offset, 128-bit hash) instead.
5. Ranges of repeated starts come together per text, which is cut once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliary.llm.common import discard, few, hold, map_texts, marked, marks, materialise, sorted_groups, text_slices, texts_of
from foliary.llm.windows import gram_hashes, rightmost_minima

#: Bytes of a repeated string.
LENGTH = 400
#: Distinct contexts of one anchor that one task takes.
HOT_CONTEXTS = 1024
#: Bytes of contexts that share one transform.
BLOCK_BYTES = 512 << 10
#: Anchor rows for each file of what is written about them.
FILE_ROWS = 50_000
#: Bytes of contexts that a task gets.
TASK_BYTES = 2 << 20
#: Mixed intervals up to this size are spread out symbol by symbol; larger ones use rank queries.
SMALL = 64


def gram_of(length: int) -> int:
    """Size of the anchors' grams: the largest power of two that is at most two thirds of the window."""
    return 1 << max(0, (max(1, length * 2 // 3)).bit_length() - 1)


def anchors(raw: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, position, first start, last start) of each anchor; no anchors in texts shorter than a window."""
    if len(raw) < length:
        return (np.empty(0, np.uint64),) + (np.empty(0, np.int64),) * 3
    k = gram_of(length)
    h = gram_hashes(np.frombuffer(raw, np.uint8), k)
    at = rightmost_minima(h, length - k + 1)
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    last = np.r_[first[1:], len(at)] - 1
    return h[at[first]], at[first], first, last


def suffix_order(codes: np.ndarray, enough: int) -> np.ndarray:
    """Suffixes sorted by their first ``enough`` codes at least; suffixes equal that far stay in any order."""
    n = len(codes)
    wide = np.zeros(n + 4, np.int64)
    wide[:n] = codes + 1
    top = int(codes.max()) + 2
    bits = top.bit_length()
    per = max(1, min(4, 62 // bits))
    key = wide[:n].copy()
    for i in range(1, per):
        key = (key << bits) | wide[i : n + i]
    order = np.argsort(key)
    sorted_key = key[order]
    new = np.r_[True, sorted_key[1:] != sorted_key[:-1]]
    place = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = place
    width = per
    while width < enough:
        # only suffixes that share their rank with another are sorted on
        open_ = ~(new & np.r_[new[1:], True])
        slots = np.flatnonzero(open_)
        if not len(slots):
            break
        who = order[slots]
        ahead = who + width
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        by = np.argsort(rank[who] * (n + 1) + second)
        who, second = who[by], second[by]
        order[slots] = who
        first = rank[who]
        change = np.r_[True, (first[1:] != first[:-1]) | (second[1:] != second[:-1])]
        new[slots] = change
        place = np.maximum.accumulate(np.where(change, slots, 0))
        rank[who] = place
        width *= 2
    return order


def repeated_borders(bwt: np.ndarray, length: int) -> np.ndarray:
    """True at border i (between sorted suffixes i-1 and i) where ``length`` symbols or more are common.

    Backward extension by breadth: the intervals of all strings of v symbols
    that set a border at v-1 are extended by each symbol in front; the end of an
    extended interval is a border of value v if none was set there before. Such
    intervals come by increasing v, and after v = length-1 the borders left open
    have common prefixes of ``length`` at least.
    """
    n = len(bwt)
    alphabet, symbol = np.unique(bwt, return_inverse=True)
    counts = np.bincount(symbol, minlength=len(alphabet))
    start = np.r_[0, np.cumsum(counts)[:-1]]
    by_symbol = np.argsort(symbol, kind="stable")
    step = np.empty(n, np.int64)  # last-to-first mapping
    step[by_symbol] = np.arange(n)
    where = np.split(by_symbol, start[1:])
    head = np.zeros(n + 1, bool)  # rows at which a first symbol begins
    head[start] = True
    # The end of the run of equal symbols that each row is in.
    last = np.r_[symbol[1:] != symbol[:-1], True]
    run_end = np.minimum.accumulate(np.where(last, np.arange(1, n + 1), n)[::-1])[::-1]
    is_open = np.ones(n + 1, bool)
    is_open[0] = is_open[n] = False
    # Strings of one symbol. A symbol met once (each context's end sign is one) has its borders now:
    # nothing that begins with it can set another, so it need not be put in front again.
    low, high = start, start + counts
    is_open[high] = False
    common = np.flatnonzero(counts > 1).tolist()
    for _ in range(length - 1):
        if not len(low):
            break
        size = high - low
        plain = run_end[low] >= high  # one symbol in front of all: the interval moves as a whole
        to = step[low[plain]]
        lows, highs = [to], [to + size[plain]]
        mixed = ~plain
        if mixed.any():
            low, high, size = low[mixed], high[mixed], size[mixed]
            few = size <= SMALL
            a, s = low[few], size[few]
            if len(a):
                ends = np.cumsum(s)
                owner = np.repeat(np.arange(len(a)), s)
                row = np.arange(ends[-1]) - np.repeat(ends - s, s) + np.repeat(a, s)
                # by owner, then by where the mapping leads: symbols come in runs, each a new interval
                to = step[row]
                to = to[np.argsort(owner * (n + 1) + to)]
                edge = np.r_[True, (to[1:] != to[:-1] + 1) | (owner[1:] != owner[:-1]) | head[to[1:]]]
                lows.append(to[edge])
                highs.append(to[np.r_[edge[1:], True]] + 1)
            a, b = low[~few], high[~few]
            if len(a):
                for c in common:
                    i, j = where[c].searchsorted(a), where[c].searchsorted(b)
                    has = i < j
                    lows.append(start[c] + i[has])
                    highs.append(start[c] + j[has])
        low, high = np.concatenate(lows), np.concatenate(highs)
        fresh = is_open[high]
        low, high = low[fresh], high[fresh]
        is_open[high] = False
    return is_open[:n]


def repeated_starts(contexts: list[bytes], length: int) -> list[np.ndarray]:
    """For each context the starts of its windows of ``length`` bytes that also start elsewhere in the contexts."""
    total = sum(map(len, contexts)) + len(contexts)
    codes = np.empty(total, np.int64)
    bounds, at = [], 0
    for i, c in enumerate(contexts):  # each context ends in a sign of its own, below all bytes
        codes[at : at + len(c)] = np.frombuffer(c, np.uint8)
        codes[at + len(c)] = -1
        bounds.append((at, at + len(c)))
        at += len(c) + 1
    ends = np.flatnonzero(codes < 0)
    codes += len(contexts)
    codes[ends] = np.arange(len(contexts))
    order = suffix_order(codes, length + 1)
    border = repeated_borders(codes[order - 1], length)
    hit = border | np.r_[border[1:], False]
    starts = np.zeros(total, bool)
    starts[order[hit]] = True
    return [np.flatnonzero(starts[a:b]) for a, b in bounds]


def runs(values: np.ndarray) -> list[tuple[int, int]]:
    """First and last of each run of consecutive integers."""
    if not len(values):
        return []
    cut = np.flatnonzero(np.diff(values) > 1)
    return list(zip(values[np.r_[0, cut + 1]].tolist(), values[np.r_[cut, len(values) - 1]].tolist(), strict=True))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """key (the id as text), two hashes of the text, the text: rows that agree in these are the same text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("key"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(7), text).alias("t2"), text.alias("raw"), F.col(id_col).alias("row_id"))


def _anchor_hashes(keyed: DataFrame, length: int) -> DataFrame:
    """(anchor) of every anchor of every text."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        hold("suffixes")
        found = [anchors(text.encode("utf-8"), length)[0] for text in texts_of(batch, "raw")]
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([*found, np.empty(0, np.uint64)]).view(np.int64))], ["anchor"])

    return map_texts(keyed, ["raw"], "raw", "anchor bigint", work)


def _anchor_rows(keyed: DataFrame, length: int, bitmap: np.ndarray) -> DataFrame:
    """Where marked anchors are, and what their contexts hash to."""
    shipped = keyed.sparkSession.sparkContext.broadcast(bitmap)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        who, grams, ctx, lo, hi, pos = [], [], [], [], [], []
        for i, text in enumerate(texts_of(batch, "raw")):
            raw = text.encode("utf-8")
            h, at, first, last = anchors(raw, length)
            keep = np.flatnonzero(marked(shipped.value, h))
            if len(keep):
                h, at, first, last = h[keep], at[keep], first[keep], last[keep]
                who.append(np.full(len(h), i))
                grams.append(h.view(np.int64))
                pos.append(at)
                lo.append(first)
                hi.append(last)
                ctx.append(np.fromiter((xxhash.xxh3_64_intdigest(raw[a : b + length]) for a, b in zip(first.tolist(), last.tolist(), strict=True)), np.uint64, len(h)).view(np.int64))
        flat = lambda x: np.concatenate(x) if x else np.empty(0, np.int64)
        rows = pa.array(flat(who).astype(np.int64))
        return pa.RecordBatch.from_arrays([*(batch.column(c).take(rows) for c in ("key", "t1", "t2")), *(pa.array(flat(x).astype(np.int64)) for x in (grams, ctx)), *(pa.array(flat(x).astype(np.int32)) for x in (pos, lo, hi))], ["key", "t1", "t2", "anchor", "ctx", "pos", "lo", "hi"])

    return map_texts(keyed, ["key", "t1", "t2", "raw"], "raw", "key string, t1 bigint, t2 bigint, anchor bigint, ctx bigint, pos int, lo int, hi int", work)


def _contexts(keyed: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of wanted contexts (anchor, ctx, n_ctx and where one occurrence is), fetched from the texts."""
    per_text = wanted.groupBy("key", "t1", "t2").agg(F.collect_list(F.struct("anchor", "ctx", "pos", "lo", "hi", "hot")).alias("wanted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("suffixes")
        for batch in batches:
            for piece in text_slices(batch, "raw"):
                out = [[], [], [], [], []]
                for text, asked in zip(piece.column("raw").to_pylist(), piece.column("wanted").to_pylist(), strict=True):
                    raw = text.encode("utf-8")
                    for w in asked:
                        for column, x in zip(out, (w["anchor"], w["ctx"], w["lo"] - w["pos"], w["hot"], raw[w["lo"] : w["hi"] + length]), strict=True):
                            column.append(x)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, [pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary()], strict=True)], ["anchor", "ctx", "offset", "hot", "content"])

    one = keyed.join(per_text, ["key", "t1", "t2"])
    return one.select("raw", "wanted").mapInArrow(run, "anchor bigint, ctx bigint, `offset` int, hot boolean, content binary")


def _by_suffixes(contexts: DataFrame, length: int) -> DataFrame:
    """(anchor, ctx, start_from, start_to) of repeated windows, from transforms over whole anchor groups."""

    def solve(held: list[pa.Table]) -> pa.RecordBatch:
        t = pa.concat_tables(held)
        found = repeated_starts([bytes(x) for x in t.column("content").to_pylist()], length)
        rows = [(a, c, x, y) for a, c, s in zip(t.column("anchor").to_pylist(), t.column("ctx").to_pylist(), found, strict=True) for x, y in runs(s)]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate([pa.int64(), pa.int64(), pa.int32(), pa.int32()])], ["anchor", "ctx", "start_from", "start_to"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("suffixes")
        held, size = [], 0
        for group in sorted_groups(batches, ["anchor"]):
            group = _once(group)
            held.append(group)
            size += group.column("content").nbytes
            if size >= BLOCK_BYTES:
                yield solve(held)
                held, size = [], 0
        if held:
            yield solve(held)

    cold = contexts.where(~F.col("hot")).select("anchor", "ctx", "content")
    # Transforms cost far more than the bytes they read tell, so Spark is not left to merge partitions by their bytes.
    size = cold.agg(F.sum(F.octet_length("content"))).first()[0] or 0
    most = 4 * int(contexts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cold.repartition(max(1, min(most, -(-size // TASK_BYTES))), "anchor").sortWithinPartitions("anchor", "ctx").mapInArrow(run, "anchor bigint, ctx bigint, start_from int, start_to int")


def _once(group: pa.Table) -> pa.Table:
    """Rows of one anchor, each context once (a text held in two equal rows brings it twice)."""
    _, first = np.unique(group.column("ctx").to_numpy(), return_index=True)
    return group.take(pa.array(np.sort(first)))


def _by_windows(contexts: DataFrame, length: int) -> DataFrame:
    """The same ranges for hot anchors: each window counted by (anchor, offset, hash of its bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("suffixes")
        for batch in batches:
            for piece in text_slices(batch, "content"):
                cols = [[], [], [], [], [], []]
                for a, c, off, raw in zip(*(piece.column(x).to_pylist() for x in ("anchor", "ctx", "offset", "content")), strict=True):
                    for s in range(len(raw) - length + 1):
                        d = xxhash.xxh3_128_intdigest(raw[s : s + length])
                        for column, x in zip(cols, (a, c, s, off + s, d >> 64, d & (1 << 64) - 1), strict=True):
                            column.append(x)
                arrays = [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.int32()), *(pa.array(np.array(x, np.uint64).view(np.int64)) for x in cols[4:])]
                yield pa.RecordBatch.from_arrays(arrays, ["anchor", "ctx", "start", "offset", "h1", "h2"])

    hot = contexts.where("hot").select("anchor", "ctx", "offset", "content").dropDuplicates(["anchor", "ctx"])
    windows = hot.mapInArrow(run, "anchor bigint, ctx bigint, start int, `offset` int, h1 bigint, h2 bigint")
    twice = windows.groupBy("anchor", "offset", "h1", "h2").agg(F.count("*").alias("n")).where("n > 1")
    return windows.join(twice, ["anchor", "offset", "h1", "h2"]).select("anchor", "ctx", F.col("start").alias("start_from"), F.col("start").alias("start_to"))


def repeated_ranges(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", hot_contexts: int = HOT_CONTEXTS) -> DataFrame:
    """(key, t1, t2, ranges array<struct<first, last>>): starts of repeated windows per text that has any."""
    keyed = _keyed(docs, id_col, text_col)
    repeated = materialise(_anchor_hashes(keyed, length).groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"))
    shared = materialise(_anchor_rows(keyed, length, marks(repeated, "anchor")))
    discard(repeated)
    # Written out, so that the join by anchor has plain shuffles on both sides, of which Spark can split a hot anchor.
    many = shared.count()
    by_ctx = materialise(few(shared.groupBy("anchor", "ctx").agg(F.count("*").alias("n"), F.min(F.struct("key", "t1", "t2", "pos", "lo", "hi")).alias("at")), many, FILE_ROWS))
    by_anchor = by_ctx.groupBy("anchor").agg(F.count("*").alias("n_ctx")).where("n_ctx > 1")
    wanted = by_ctx.join(by_anchor, "anchor").select("anchor", "ctx", "at.*", (F.col("n_ctx") > hot_contexts).alias("hot"))
    contexts = materialise(few(_contexts(keyed, wanted, length), many, FILE_ROWS))
    whole = by_ctx.where("n > 1").select("anchor", "ctx", F.lit(0).alias("start_from"), (F.col("at.hi") - F.col("at.lo")).alias("start_to"))
    parts = whole.unionByName(_by_suffixes(contexts, length)).unionByName(_by_windows(contexts, length))
    placed = shared.join(parts, ["anchor", "ctx"]).select("key", "t1", "t2", F.struct((F.col("lo") + F.col("start_from")).alias("first"), (F.col("lo") + F.col("start_to")).alias("last")).alias("r"))
    ranges = materialise(few(placed.groupBy("key", "t1", "t2").agg(F.collect_set("r").alias("ranges")), many, FILE_ROWS))
    discard(shared, by_ctx, contexts)
    return ranges


def cut(raw: bytes, ranges: list[dict], length: int) -> tuple[bytes, list[tuple[int, int]]]:
    """What is left of the bytes, and the maximal removed runs [from, to)."""
    spans: list[list[int]] = []
    for a, b in sorted((r["first"], r["last"] + length) for r in ranges):
        if spans and a <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], b)
        else:
            spans.append([a, b])
    kept, at = [], 0
    for a, b in spans:
        kept.append(raw[at:a])
        at = b
    return b"".join([*kept, raw[at:]]), [(a, b) for a, b in spans]


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", hot_contexts: int = HOT_CONTEXTS) -> DataFrame:
    """(id, n_bytes, n_removed, spans array<struct<from, to>>, kept binary) for every row.

    Texts are UTF-8 bytes, null is empty; spans are maximal removed runs, byte
    offsets, end excluded. Rows with equal id and text, or null ids, are texts
    like any other, so a row that repeats another loses all bytes that a window
    covers. Texts shorter than ``length`` keep everything.
    """
    ranges = repeated_ranges(docs, length, id_col, text_col, hot_contexts)
    joined = _keyed(docs, id_col, text_col).join(ranges, ["key", "t1", "t2"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("suffixes")
        for batch in batches:
            for piece in text_slices(batch, "raw"):
                raws = [x.encode("utf-8") for x in piece.column("raw").to_pylist()]
                done = [cut(raw, r or [], length) for raw, r in zip(raws, piece.column("ranges").to_pylist(), strict=True)]
                spans = pa.array([[{"from": a, "to": b} for a, b in s] for _, s in done], pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())])))
                sizes = [len(x) for x in raws]
                yield pa.RecordBatch.from_arrays([piece.column("row_id"), pa.array(sizes, pa.int64()), pa.array([n - len(k) for n, (k, _) in zip(sizes, done, strict=True)], pa.int64()), spans, pa.array([k for k, _ in done], pa.binary())], [id_col, "n_bytes", "n_removed", "spans", "kept"])

    kind = docs.schema[id_col].dataType.simpleString()
    return joined.select("row_id", "raw", "ranges").mapInArrow(run, f"`{id_col}` {kind}, n_bytes bigint, n_removed bigint, spans array<struct<`from`:bigint,`to`:bigint>>, kept binary")


def kept_texts(cut_rows: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, kept_text) of rows of :func:`remove_repeats`: what is left as text, without characters of which only some bytes are left."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        left = [(x or b"").decode("utf-8", "ignore") for x in batch.column("kept").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(id_col), pa.array(left, pa.string())], [id_col, "kept_text"])

    kind = cut_rows.schema[id_col].dataType.simpleString()
    return map_texts(cut_rows, [id_col, "kept"], "kept", f"`{id_col}` {kind}, kept_text string", work)

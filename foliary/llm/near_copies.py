"""Near copies at a shingle similarity: all pairs, found through exact bounds and verified by whole sets.

Exact copies are folded first. Each text sends its prefix, the shingles that
come first in one order of all shingles and of which two texts of the
similarity must share one (n - ceil(s n) + 1 of n). Rare shingles come first:
those that are frequent in a sample are ranked by their count, all others
before them by their hash. Any order gives the same pairs, so the sample only
decides how many candidates there are. Candidates are bounded by the sizes and
by the places of the shared shingle, which no pair of the similarity exceeds.

Under a shingle with many texts the links of the Gray index and of a few
leaders are verified first. Then all pairs of texts that are not yet connected
follow in blocks, bounded by parity bitmaps: those of two sets differ in no
more bits than the sets do in shingles. Bitmaps are as wide as their sets ask
for; a wider one folds to the width of the other, so all pairs are bounded by
them before sets are made and moved. So nothing is dropped that could link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliary.llm.common import discard, few, hold, map_texts, marked, marks, materialise, sorted_groups, text_slices, texts_of
from foliary.llm.components import connected_components
from foliary.llm.simhash import gray_rank, hashes, link_edges, majority

#: Texts under a shingle of which all pairs are candidates at once; leaders that are tried first under one with more.
ALL_PAIRS, LEADERS = 48, 64
#: Texts of a block under a shingle with many; pairs of blocks are tasks of their own.
HOT_SLOT = 20_000
#: Words of 64 bits in the least parity bitmap, by which blocks are compared, and in the largest.
WORDS, MOST_WORDS = 16, 4096
#: Bits of a bitmap for each shingle.
BITS_EACH = 4
#: Texts for each file of what is written about them.
FILE_ROWS = 10_000
#: Nearest unconnected texts that are tried before all.
NEAREST = 4
#: One of so many texts is sampled for frequent shingles; how often they must occur there, and how many are ranked.
SAMPLE, FREQUENT, RANKED = 64, 3, 100_000


def _signed(values) -> np.ndarray:
    return np.array(values, np.uint64).view(np.int64)


def _described(docs: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """(id, t1, t2, fp, size, bits, wide) of every row: two hashes of the text, its fingerprint, size and bitmaps of its shingle set. No shuffle."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        hold("near copies")
        fps, sizes, bits, wide = [], [], [], []
        for text in texts_of(batch, "raw"):
            h = hashes(text, size)
            fps.append(majority(h))
            h = np.unique(h)
            sizes.append(len(h))
            odd = parity(h)
            bits.append(folded(odd, WORDS).tobytes())
            wide.append(odd.tobytes() if len(odd) > WORDS else None)
        return pa.RecordBatch.from_arrays([batch.column("id"), batch.column("t1"), batch.column("t2"), pa.array(_signed(fps)), pa.array(sizes, pa.int64()), pa.array(bits, pa.binary()), pa.array(wide, pa.binary())], ["id", "t1", "t2", "fp", "size", "bits", "wide"])

    raw = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(raw).alias("t1"), F.xxhash64(F.lit(7), raw).alias("t2"), raw.alias("raw"))
    kind = docs.schema[id_col].dataType.simpleString()
    return map_texts(rows, ["id", "t1", "t2", "raw"], "raw", f"id {kind}, t1 bigint, t2 bigint, fp bigint, size bigint, bits binary, wide binary", work)


def prefix(h: np.ndarray, similarity: float, ranked: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The first shingles of a sorted set in the order of all: two sets of the similarity share one of them."""
    values, rank = ranked
    if len(values):
        at = np.minimum(np.searchsorted(values, h), len(values) - 1)
        h = h[np.argsort(np.where(values[at] == h, rank[at], 0), kind="stable")]
    return h[: len(h) - int(np.ceil(similarity * len(h) - 1e-9)) + 1]


def parity(h: np.ndarray) -> np.ndarray:
    """Bitmap of a set: a bit is set where an odd number of its shingles fall. Two of one width differ in as many bits as the sets in shingles, or fewer."""
    words = min(MOST_WORDS, max(WORDS, 1 << max(0, BITS_EACH * len(h) // 64 - 1).bit_length()))
    odd = np.bincount((h >> np.uint64(20)).astype(np.int64) % (64 * words), minlength=64 * words).astype(np.uint8) & 1
    return np.packbits(odd).view(np.uint64)


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps (in the last axis) as they are in fewer words: bits that fall together are added."""
    while bits.shape[-1] > words:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


def _most_apart(both: np.ndarray, similarity: float) -> np.ndarray:
    """Shingles in which two sets of the similarity differ at most; ``both`` are their sizes together."""
    return both - 2 * np.ceil(similarity / (1 + similarity) * both - 1e-9)


def _possible(x: np.ndarray, y: np.ndarray, similarity: float) -> np.ndarray:
    """Whether texts that share a shingle can be of the similarity; x and y hold size << 32 | place of it in the order.

    True for the first shingle that such a pair shares.
    """
    sx, sy, px, py = x >> 32, y >> 32, x & 0xFFFFFFFF, y & 0xFFFFFFFF
    most = np.minimum(sx - px, sy - py)
    return (np.minimum(sx, sy) >= similarity * np.maximum(sx, sy) - 1e-9) & (most * (1 + similarity) >= similarity * (sx + sy) - 1e-9)


def _pairs_of(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a group given in Gray order that are tried first: each with its neighbour and its nearest leaders."""
    n = len(fp)
    lead = np.unique(np.linspace(0, n - 1, LEADERS).astype(np.int64))
    apart = lambda some: np.bitwise_count(some[:, None] ^ fp[lead][None, :])
    near = np.concatenate([lead[np.argpartition(apart(fp[k : k + 4096]), min(3, len(lead) - 1), axis=1)[:, :4]] for k in range(0, n, 4096)])
    i = np.concatenate([np.repeat(np.arange(n), near.shape[1]), np.arange(n - 1)])
    j = np.concatenate([near.ravel(), np.arange(1, n)])
    return i[i != j], j[i != j]


def _block_pairs(x: pa.Table, y: pa.Table, similarity: float, nearest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of texts of two blocks (or of one) that are not connected and that no bound excludes; of each x the nearest, with 0 all."""
    take = lambda t, c: t[c].to_numpy()
    bits = lambda t: np.frombuffer(b"".join(t["bits"].to_pylist()), np.uint64).reshape(-1, WORDS)
    yn, yat, yroot, ybits = take(y, "n"), take(y, "at"), take(y, "root"), bits(y)
    xn, xat, xroot, xbits = (yn, yat, yroot, ybits) if x is y else (take(x, "n"), take(x, "at"), take(x, "root"), bits(x))
    step = max(1, (1 << 19) // len(yn))
    for k in range(0, len(xn), step):
        part, rest = slice(k, k + step), slice(k if x is y else 0, None)
        keep = _possible(xat[part, None], yat[None, rest], similarity) & (xroot[part, None] != yroot[None, rest])
        if not keep.any():
            continue
        apart = np.zeros(keep.shape, np.uint16)
        for w in range(WORDS):
            apart += np.bitwise_count(xbits[part, w, None] ^ ybits[None, rest, w])
        both = (xat[part, None] >> 32) + (yat[None, rest] >> 32)
        keep &= apart <= _most_apart(both, similarity)
        if nearest and keep.shape[1] > nearest:
            apart[~keep] = 1 << 15
            best = np.argpartition(apart, nearest, axis=1)[:, :nearest]
            only = np.zeros(keep.shape, bool)
            np.put_along_axis(only, best, True, axis=1)
            keep &= only
        i, j = np.nonzero(keep)
        yield xn[part][i], yn[rest][j]


def _ordered(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])


def _raw(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(least, n, raw) of every row, by the names of a text's row that stands for it."""
    raw = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("least"), _number(F.xxhash64(raw), F.xxhash64(F.lit(7), raw)).alias("n"), raw.alias("raw"))


def _sets(docs: DataFrame, asked: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """(n, shingles) of the asked (n, least) and, by false marks, of some others; made where the texts are."""
    bitmap = docs.sparkSession.sparkContext.broadcast(marks(asked.select(F.xxhash64("n", "least").alias("mark")), "mark"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("near copies")
        for batch in batches:
            for piece in text_slices(batch, "raw"):
                piece = piece.filter(pa.array(marked(bitmap.value, piece.column("mark").to_numpy())))
                found = [np.unique(hashes(t, size)).tobytes() for t in texts_of(piece, "raw")]
                yield pa.RecordBatch.from_arrays([piece.column("n"), pa.array(found, pa.binary())], ["n", "shingles"])

    rows = _raw(docs, id_col, text_col).select("n", F.xxhash64("n", "least").alias("mark"), "raw")
    return rows.mapInArrow(run, "n bigint, shingles binary").dropDuplicates(["n"])


def _ranked(docs: DataFrame, size: int, id_col: str, text_col: str) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles of a sample, sorted, and their ranks from the rarest on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("near copies")
        for batch in batches:
            for piece in text_slices(batch, "raw"):
                for t in texts_of(piece, "raw"):
                    yield pa.RecordBatch.from_arrays([pa.array(np.unique(hashes(t, size)).view(np.int64))], ["h"])

    sampled = _raw(docs, id_col, text_col).where(F.pmod("n", F.lit(SAMPLE)) == 0).select("n", "raw").dropDuplicates(["n"])
    counts = sampled.select("raw").mapInArrow(run, "h bigint").groupBy("h").agg(F.count("*").alias("c"))
    top = counts.where(F.col("c") >= FREQUENT).orderBy(F.desc("c"), "h").limit(RANKED).toArrow()
    values = top["h"].to_numpy().view(np.uint64)
    order = np.argsort(values)
    return values[order], (len(values) - np.arange(len(values)))[order]


def _shared(known: DataFrame, docs: DataFrame, size: int, similarity: float, id_col: str, text_col: str) -> DataFrame:
    """(a, b, key, at): candidate pairs, with null keys, and the texts a under keys that more than ALL_PAIRS share."""
    ranked = docs.sparkSession.sparkContext.broadcast(_ranked(docs, size, id_col, text_col))

    def keys(batch: pa.RecordBatch) -> pa.RecordBatch:
        hold("near copies")
        found, sizes = [], []
        for t in texts_of(batch, "raw"):
            h = np.unique(hashes(t, size))
            # Texts without words meet under a key of their own.
            found.append(prefix(h, similarity, ranked.value) if len(h) else np.zeros(1, np.uint64))
            sizes.append(len(h))
        ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found).view(np.int64)))
        return pa.RecordBatch.from_arrays([batch.column("n"), batch.column("least"), pa.array(sizes, pa.int64()), lists], ["n", "least", "size", "keys"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("near copies")
        held: list[np.ndarray] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _joined(held, batch)
            cut = int(np.searchsorted(rows[0], rows[0][-1]))
            yield from _runs(*(c[:cut] for c in rows), similarity)
            held = [c[cut:] for c in rows]
        if held:
            yield from _runs(*held, similarity)

    kind = docs.schema[id_col].dataType.simpleString()
    sent = map_texts(_raw(docs, id_col, text_col), ["n", "least", "raw"], "raw", f"n bigint, least {kind}, size bigint, keys array<bigint>", keys)
    one = sent.join(known.select("n", "least"), ["n", "least"])
    apart = one.select("n", "size", F.element_at("keys", 1).alias("first"), F.posexplode("keys").alias("place", "key")).select("key", "n", F.shiftleft("size", 32).bitwiseOR(F.col("place").cast("bigint")).alias("at"), "first")
    return apart.repartition("key").sortWithinPartitions("key", "n").mapInArrow(run, "a bigint, b bigint, key bigint, at bigint")


def _joined(held: list[np.ndarray], batch: pa.RecordBatch) -> list[np.ndarray]:
    """Held rows and those of a batch, all sorted by key and n; each text once under a key, also if its row is repeated."""
    rows = [batch.column(c).to_numpy() for c in ("key", "n", "at", "first")]
    if held:
        rows = [np.concatenate(c) for c in zip(held, rows, strict=True)]
    key, n = rows[:2]
    fresh = np.r_[True, (key[1:] != key[:-1]) | (n[1:] != n[:-1])]
    return [c[fresh] for c in rows]


def _runs(key: np.ndarray, n: np.ndarray, at: np.ndarray, first: np.ndarray, similarity: float) -> Iterator[pa.RecordBatch]:
    """Of sorted keys: the possible pairs under each that few texts share, and the rows of the others.

    Two texts whose first keys are equal meet there, so they do not come again under the next.
    """
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][: len(key)])
    length = np.repeat(np.diff(np.r_[start, len(key)]), np.diff(np.r_[start, len(key)]))
    names = ["a", "b", "key", "at"]
    crowd = length > ALL_PAIRS
    if crowd.any():
        yield pa.RecordBatch.from_arrays([pa.array(n[crowd]), pa.nulls(int(crowd.sum()), pa.int64()), pa.array(key[crowd]), pa.array(at[crowd])], names)
    few = (length > 1) & ~crowd
    key, n, at, first = key[few], n[few], at[few], first[few]
    for d in range(1, ALL_PAIRS):
        i = np.flatnonzero(key[d:] == key[:-d])
        if not len(i):
            break
        i = i[_possible(at[i], at[i + d], similarity) & ((first[i] != first[i + d]) | (first[i] == key[i]))]
        none = pa.nulls(len(i), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(n[i], n[i + d])), pa.array(np.maximum(n[i], n[i + d])), none, none], names)


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("n")).union(pairs.select(F.col("b").alias("n"))).distinct()


def _bounded(pairs: DataFrame, drawn: DataFrame, similarity: float) -> DataFrame:
    """The pairs that sizes and bitmaps do not exclude; ``drawn`` is (n, size, bits, wide)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("near copies")
        for batch in batches:
            if not batch.num_rows:
                continue
            sx, sy = batch.column("sx").to_numpy(), batch.column("sy").to_numpy()
            keep = np.minimum(sx, sy) >= similarity * np.maximum(sx, sy) - 1e-9
            raw = [batch.column(c).to_pylist() for c in ("x", "y")]
            widths = np.array([[len(b) // 8 for b in column] for column in raw])
            for wx, wy in np.unique(widths[:, keep], axis=1).T.tolist():
                at = np.flatnonzero(keep & (widths[0] == wx) & (widths[1] == wy))
                for k in range(0, len(at), 4096):
                    some = at[k : k + 4096]
                    x, y = (folded(np.frombuffer(b"".join(column[i] for i in some), np.uint64).reshape(-1, w), min(wx, wy)) for column, w in zip(raw, (wx, wy), strict=True))
                    keep[some] = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64) <= _most_apart(sx[some] + sy[some], similarity)
            at = pa.array(np.flatnonzero(keep))
            yield pa.RecordBatch.from_arrays([batch.column("a").take(at), batch.column("b").take(at)], ["a", "b"])

    widest = F.coalesce("wide", "bits")
    left = drawn.select(F.col("n").alias("a"), F.col("size").alias("sx"), widest.alias("x"))
    right = drawn.select(F.col("n").alias("b"), F.col("size").alias("sy"), widest.alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "sx", "sy", "x", "y").mapInArrow(run, "a bigint, b bigint")


def _verified(pairs: DataFrame, known: DataFrame, docs: DataFrame, similarity: float, size: int, id_col: str, text_col: str) -> DataFrame:
    """The pairs whose shingle sets are of the similarity. Only sets of texts that a pair names are made and moved."""
    n = pairs.count()
    asked = materialise(few(_ends(pairs).join(known.select("n", "least"), "n"), n, 100_000))
    shingles = materialise(few(_sets(docs, asked, size, id_col, text_col), n, 1_000))
    both = pairs.join(shingles.select(F.col("n").alias("a"), F.col("shingles").alias("x")), "a").join(shingles.select(F.col("n").alias("b"), F.col("shingles").alias("y")), "b")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("near copies")
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column("x"), batch.column("y"), strict=True)):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if min(len(p), len(q)) < similarity * max(len(p), len(q)):
                    continue
                z = np.sort(np.concatenate((p, q)), kind="stable")
                shared = int((z[1:] == z[:-1]).sum())
                keep[i] = shared >= similarity * (len(z) - shared)
            at = pa.array(np.flatnonzero(keep))
            yield pa.RecordBatch.from_arrays([batch.column("a").take(at), batch.column("b").take(at)], ["a", "b"])

    found = materialise(few(both.select("a", "b", "x", "y"), n, 1_000).mapInArrow(verify, "a bigint, b bigint"))
    discard(asked, shingles)
    return found


def _unconnected(crowd: DataFrame, parts: DataFrame, similarity: float, block: int, nearest: int) -> DataFrame:
    """(a, b) under keys with many texts: pairs of texts of different components that no bound excludes."""
    rooted = crowd.join(parts.withColumnRenamed("vertex", "n"), "n", "left").withColumn("root", F.coalesce("component", "n")).drop("component")
    open_ = rooted.groupBy("key").agg(F.count("*").alias("many"), F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    blocks = F.ceil(F.col("many") / block).cast("int")
    rows = rooted.join(open_, "key").withColumn("blocks", blocks).withColumn("own", F.expr("cast(pmod(xxhash64(n), blocks) as int)"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "n", "at", "root", "bits")
    by = ["key", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("near copies")
        for group in sorted_groups(batches, by):
            i, j = group["i"][0].as_py(), group["j"][0].as_py()
            x = y = group
            if i != j:
                x, y = (group.filter(pc.equal(group["own"], k)) for k in (i, j))
            if len(x) and len(y):
                for a, b in _block_pairs(x, y, similarity, nearest):
                    yield _ordered(a, b)

    return rows.repartition(*by).sortWithinPartitions(*by).mapInArrow(run, "a bigint, b bigint").distinct()


def _first_pairs(crowd: DataFrame) -> DataFrame:
    """(a, b) under keys with many texts: those that are tried first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("near copies")
        for group in sorted_groups(batches, ["key"]):
            fp, n = group["fp"].to_numpy().view(np.uint64), group["n"].to_numpy()
            order = np.argsort(gray_rank(fp), kind="stable")
            i, j = _pairs_of(fp[order])
            yield _ordered(n[order][i], n[order][j])

    return crowd.select("key", "n", "fp").repartition("key").sortWithinPartitions("key").mapInArrow(run, "a bigint, b bigint")


def similar_components(known: DataFrame, docs: DataFrame, size: int, similarity: float, radius: int, hot_slot: int, id_col: str, text_col: str, many: int) -> DataFrame:
    """(vertex, component): distinct texts, by their numbers, connected by pairs of the similarity. ``known`` is (n, least, fp, size, bits, wide): one row per text, ``least`` the id of a row that has it; ``many`` are about as many."""
    by_fp = known.groupBy("fp").agg(F.min("n").alias("n"))
    linked = link_edges(by_fp.select("fp"), radius)
    left = by_fp.select(F.col("fp").alias("a"), F.col("n").alias("na"))
    right = by_fp.select(F.col("fp").alias("b"), F.col("n").alias("nb"))
    whole = linked.join(left, "a").join(right, "b").select(F.least("na", "nb").alias("a"), F.greatest("na", "nb").alias("b"))
    same = known.join(by_fp.withColumnRenamed("n", "first"), "fp").where("n <> first").select(F.col("first").alias("a"), F.col("n").alias("b"))
    shared = materialise(few(_shared(known, docs, size, similarity, id_col, text_col).distinct(), many, FILE_ROWS))
    pairs = shared.where("key is null").select("a", "b").union(whole).union(same)
    crowd = shared.where("key is not null").select("key", F.col("a").alias("n"), "at")
    crowded = not crowd.isEmpty()
    if crowded:
        crowd = materialise(few(crowd.join(known.select("n", "fp", "bits"), "n"), many, FILE_ROWS))
        pairs = pairs.union(_first_pairs(crowd))
    pairs = materialise(few(_bounded(pairs.distinct(), known, similarity), many, FILE_ROWS))
    verified = lambda found: _verified(found, known, docs, similarity, size, id_col, text_col)
    same = verified(pairs)
    parts = connected_components(same, rows=many)
    discard(shared, pairs)
    for nearest in (NEAREST, 0) if crowded else ():
        more = materialise(few(_bounded(_unconnected(crowd, parts, similarity, hot_slot, nearest), known, similarity), many, FILE_ROWS))
        if more.isEmpty():
            discard(more)
            break
        new = verified(more)
        before, parts = parts, connected_components(new.union(parts.select(F.col("vertex").alias("a"), F.col("component").alias("b"))), rows=many)
        discard(more, new, before)
    discard(same, *[crowd] * crowded)
    return parts


def near_copy_groups(docs: DataFrame, size: int = 5, similarity: float = 0.8, radius: int = 2, id_col: str = "doc_id", text_col: str = "text", hot_slot: int = HOT_SLOT) -> DataFrame:
    """(id, component_id) of every row: rows connected by texts that are equal or at least ``similarity`` alike.

    ``component_id`` is the smallest id of the group. Null texts are empty and
    equal each other; texts without words are alike. Rows with a null id keep
    their group's name, or null in a group of such rows only.
    """
    rows = materialise(_described(docs, size, id_col, text_col))
    once = rows.groupBy("t1", "t2").agg(F.min("id").alias("least"), *[F.first(c).alias(c) for c in ("fp", "size", "bits", "wide")])
    many = rows.count()
    texts = materialise(few(once.select("t1", "t2", _number(F.col("t1"), F.col("t2")).alias("n"), "least", "fp", "size", "bits", "wide"), many, FILE_ROWS))
    known = texts.where("least is not null").select("n", "least", "fp", "size", "bits", "wide")
    parts = similar_components(known, docs, size, similarity, radius, hot_slot, id_col, text_col, many)
    member = texts.join(parts.withColumnRenamed("vertex", "n"), "n", "left").select("t1", "t2", "least", F.coalesce("component", "n").alias("root"))
    groups = member.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.select("id", "t1", "t2").join(member.join(groups, "root").select("t1", "t2", "component_id"), ["t1", "t2"]).select(F.col("id").alias(id_col), "component_id")


def _number(t1: Column, t2: Column) -> Column:
    """One number for a text, made of its two hashes."""
    return F.xxhash64(t1, t2)

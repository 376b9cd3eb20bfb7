"""SimHash fingerprints and links between them through a Gray-order hierarchical index.

Fingerprints within ``radius`` bits agree on at least ``BLOCKS - radius`` of
``BLOCKS`` blocks of bits, so each is sent once for every choice of that many
blocks, keyed by the chosen bits, and any two that link meet under a key. A
key's fingerprints are sorted by Gray rank, bits that all members of a node
share are factored into it as a masked pattern, and a search adds up the
differences met on the way down and drops a node with all below it once they
exceed the radius. Keys held by more than ``HOT_KEY`` distinct fingerprints
are refined in the same way by their free bits, which bounds any one index by
the number of values those bits can take.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliary.llm.common import few, hold, map_texts, materialise, sorted_groups, texts_of
from foliary.llm.components import connected_components

#: Parts that the 64 bits are cut into.
BLOCKS = 4
#: Distinct fingerprints under a key above which it is refined.
HOT_KEY = 4096
#: Members of a leaf, and children of an upper node.
FAN = 8
#: Pairs of query and node looked at together.
FRONTIER = 1 << 20

#: ASCII white space becomes the space, A-Z the small letters; nothing else changes.
_PLAIN = str.maketrans({**{c: " " for c in "\t\n\v\f\r"}, **{chr(c): chr(c + 32) for c in range(65, 91)}})


def shingles(text: str, size: int) -> list[bytes]:
    """Runs of ``size`` words, repeats included; of fewer words the whole sequence, of none nothing."""
    words = [w for w in text.translate(_PLAIN).split(" ") if w]
    if not words:
        return []
    raw = [w.encode("utf-8") for w in words]
    joined = b" ".join(raw)
    if len(raw) <= size:
        return [joined]
    ends = np.cumsum([len(w) + 1 for w in raw])
    stop = (ends[size - 1 :] - 1).tolist()
    start = [0, *ends[: len(raw) - size].tolist()]
    return [joined[a:b] for a, b in zip(start, stop, strict=True)]


def hashes(text: str, size: int, seed: int = 42) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(s, seed) for s in shingles(text, size)), np.uint64)


def majority(h: np.ndarray) -> int:
    """Bit b is set if it is set in over half of the hashes; zero of none."""
    if not len(h):
        return 0
    bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(bits * 2 > len(h), bitorder="little").tobytes(), "little")


def fingerprint(text: str, size: int = 3) -> int:
    return majority(hashes(text, size))


def fingerprints(docs: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp bigint) of whole texts, row by row; ``fp`` has the 64 bits in a signed long. Null and blank texts have 0."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        hold("simhash")
        values = np.array([fingerprint(t, size) for t in texts_of(batch, text_col)], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column(id_col), pa.array(values)], [id_col, "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return map_texts(docs, [id_col, text_col], text_col, f"`{id_col}` {kind}, fp bigint", work)


def gray_rank(values: np.ndarray) -> np.ndarray:
    """Position of each value in the reflected Gray sequence."""
    out = values.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        out ^= out >> np.uint64(shift)
    return out


class GrayIndex:
    """Distinct fingerprints in Gray order under levels of nodes.

    ``levels[0]`` has one entry per fingerprint, each level above one per FAN
    entries below. An entry's mask marks the bits in which all its
    fingerprints agree and no ancestor's mask has, its pattern has their
    values.
    """

    def __init__(self, values: np.ndarray):
        self.values = values[np.argsort(gray_rank(values), kind="stable")]
        agree = [np.full(len(values), ~np.uint64(0))]
        bits = [self.values]
        while len(bits[-1]) > 1:
            starts = np.arange(0, len(bits[-1]), FAN)
            ones = np.bitwise_and.reduceat(bits[-1] & agree[-1], starts)
            zeros = np.bitwise_and.reduceat(~bits[-1] & agree[-1], starts)
            agree.append(ones | zeros)
            bits.append(ones)
        self.levels = []
        for depth, (mask, pattern) in enumerate(zip(agree, bits, strict=True)):
            above = np.repeat(agree[depth + 1], FAN)[: len(mask)] if depth + 1 < len(agree) else np.uint64(0)
            self.levels.append((mask & ~above, pattern))

    def search(self, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks of (query number, position) within the radius; memory is bounded by FRONTIER pairs times the levels."""
        todo = [(len(self.levels) - 1, np.arange(len(queries)), np.zeros(len(queries), np.int64), np.zeros(len(queries), np.uint8))]
        while todo:
            depth, who, node, sofar = todo.pop()
            if len(who) > FRONTIER:
                half = len(who) // 2
                todo += [(depth, who[:half], node[:half], sofar[:half]), (depth, who[half:], node[half:], sofar[half:])]
                continue
            mask, pattern = self.levels[depth]
            sofar = sofar + np.bitwise_count((queries[who] ^ pattern[node]) & mask[node])
            near = sofar <= radius
            who, node, sofar = who[near], node[near], sofar[near]
            if not len(who):
                continue
            if not depth:
                yield who, node
                continue
            below = (node[:, None] * FAN + np.arange(FAN)).ravel()
            there = below < len(self.levels[depth - 1][0])
            todo.append((depth - 1, np.repeat(who, FAN)[there], below[there], np.repeat(sofar, FAN)[there]))


def linked(values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """For distinct fingerprints: each one's smallest connected fingerprint, where links within the radius connect.

    The links of a block of pairs lower the labels of both ends until they
    settle, so no list of all pairs is kept.
    """
    index = GrayIndex(values)
    label = np.arange(len(values))
    changed = True
    while changed:
        before = label.copy()
        for who, at in index.search(index.values, radius):
            low = np.minimum(label[who], label[at])
            np.minimum.at(label, label[who], low)
            np.minimum.at(label, label[at], low)
            while True:
                short = label[label]
                if np.array_equal(short, label):
                    break
                label = short
        changed = not np.array_equal(before, label)
    return index.values, index.values[label]


def _keys(value, free: list[tuple[int, int]], radius: int):
    """Key columns: for each choice of blocks that may agree, its number and the chosen bits."""
    out = []
    for n, chosen in enumerate(combinations(free, len(free) - radius)):
        bits = F.lit(0).cast("bigint")
        for at, width in chosen:
            bits = bits.bitwiseOR(F.shiftleft(F.shiftrightunsigned(value, at).bitwiseAND(F.lit((1 << width) - 1).cast("bigint")), at))
        out.append(F.struct(F.lit(n).alias("choice"), bits.alias("bits")))
    return F.array(*out)


def link_edges(fps: DataFrame, radius: int = 2, hot_key: int = HOT_KEY) -> DataFrame:
    """(a, b): for distinct ``fp`` values, edges that connect exactly what links within ``radius`` bits connect.

    Under each key its fingerprints are joined to the smallest one they reach
    there, so a key with n of them yields fewer than n edges, not all pairs.
    """
    if not 0 <= radius < BLOCKS:
        raise ValueError(f"radius must be 0 to {BLOCKS - 1}")
    width = 64 // BLOCKS
    blocks = [(i * width, width) for i in range(BLOCKS)]
    keyed = fps.select("fp", F.explode(_keys(F.col("fp"), blocks, radius)).alias("k")).select("fp", F.col("k.choice").alias("choice"), F.col("k.bits").alias("bits"))
    sizes = keyed.groupBy("choice", "bits").agg(F.count("*").alias("n")).where("n > 1")
    sized = keyed.join(sizes, ["choice", "bits"])
    plain = sized.where(F.col("n") <= hot_key).select("choice", "bits", F.lit(-1).alias("again"), F.lit(0).cast("bigint").alias("rest"), "fp")
    finer = []
    for n, chosen in enumerate(combinations(blocks, BLOCKS - radius)):
        free = [(at + h, width // 2) for at, _ in blocks if (at, width) not in chosen for h in (0, width // 2)]
        if len(free) > radius:
            finer.append(sized.where((F.col("n") > hot_key) & (F.col("choice") == n)).select("choice", "bits", F.posexplode(_keys(F.col("fp"), free, radius)).alias("p", "k"), "fp").select("choice", "bits", F.col("p").alias("again"), F.col("k.bits").alias("rest"), "fp"))
    for part in finer:
        plain = plain.unionByName(part)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("simhash")
        for group in sorted_groups(batches, by):
            values, root = linked(group["fp"].to_numpy().view(np.uint64), radius)
            other = values != root
            if other.any():
                yield pa.RecordBatch.from_arrays([pa.array(values[other].view(np.int64)), pa.array(root[other].view(np.int64))], ["a", "b"])

    by = ["choice", "bits", "again", "rest"]
    return plain.repartition(*by).sortWithinPartitions(*by).mapInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, size: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp bigint, component_id): documents whose fingerprints are connected by links within ``radius`` bits.

    ``component_id`` is the smallest id of the component, the document's own
    included. Null and blank texts have fingerprint 0 and link like any other.
    Rows with a null id take part, but give their component no name unless it
    has no other (then it is null). Equal fingerprints are folded before any
    search, so exact copies cost one row.
    """
    known = materialise(fingerprints(docs, size, id_col, text_col))
    many = known.count()
    folded = materialise(few(known.groupBy("fp").agg(F.min(id_col).alias("least")), many, 100_000))
    parts = connected_components(link_edges(folded.select("fp"), radius), rows=many)
    member = folded.join(parts, folded.fp == parts.vertex, "left").select("fp", F.coalesce("component", "fp").alias("root"), "least")
    names = member.groupBy("root").agg(F.min("least").alias("component_id"))
    named = member.join(names, "root").select("fp", "component_id")
    return known.join(named, "fp").select(id_col, "fp", "component_id")


def hex_fingerprint(column: str = "fp"):
    return F.lower(F.lpad(F.hex(F.col(column)), 16, "0"))

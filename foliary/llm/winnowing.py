"""Winnowing: document fingerprints that catch every shared run of K + W - 1 code points.

Each run of K code points is hashed; in every window of W hashes the least is
chosen, of equals the rightmost, and kept with its position. Two texts that
share a run of K + W - 1 code points share the window in it and so a hash;
runs shorter than K never match but by a collision.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliary.llm.common import map_texts, materialise, text_slices, texts_of
from foliary.llm.windows import gram_hashes, rightmost_minima

#: Code points of a gram (a power of two) and hashes of a window.
K, W = 16, 16


@dataclass(frozen=True)
class Fingerprint:
    hashes: np.ndarray
    positions: np.ndarray

    def digest(self) -> str:
        """32 hex digits over the chosen hashes and their positions."""
        return xxhash.xxh3_128_hexdigest(self.hashes.tobytes() + self.positions.astype("<i8").tobytes())

    def distinct(self) -> np.ndarray:
        return np.unique(self.hashes)


def winnow(text: str, k: int = K, w: int = W) -> Fingerprint:
    """A text shorter than k is one gram; the empty text has none."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    if not len(codes):
        return Fingerprint(np.empty(0, np.uint64), np.empty(0, np.int64))
    if len(codes) < k:
        return Fingerprint(np.array([xxhash.xxh3_64_intdigest(codes.tobytes())], np.uint64), np.zeros(1, np.int64))
    h = gram_hashes(codes, k)
    at = rightmost_minima(h, w)
    at = at[np.r_[True, at[1:] != at[:-1]]]
    return Fingerprint(h[at], at)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard likeness of two sorted sets of hashes; 1 of two empty ones."""
    if not len(a) and not len(b):
        return 1.0
    both = np.concatenate((a, b))
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return shared / (len(both) - shared)


def winnow_fingerprints(docs: DataFrame, k: int = K, w: int = W, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, hashes array<bigint>, positions array<bigint>) of whole texts, null as empty. Row by row, no shuffle."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [winnow(t, k, w) for t in texts_of(batch, text_col)]
        lists = pa.list_(pa.int64())
        return pa.RecordBatch.from_arrays([batch.column(id_col), pa.array([f.hashes.view(np.int64) for f in found], lists), pa.array([f.positions for f in found], lists)], [id_col, "hashes", "positions"])

    kind = docs.schema[id_col].dataType.simpleString()
    return map_texts(docs, [id_col, text_col], text_col, f"`{id_col}` {kind}, hashes array<bigint>, positions array<bigint>", work)


def edit(text: str, after: str) -> str:
    """The last half of the code points gives way to as many from the start of the next text, or all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


RESULT = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_RESULT_TYPES = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
_RESULT_SQL = "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compare(text: str, fp: Fingerprint, own: np.ndarray, after: str, after_own: np.ndarray, k: int, w: int) -> tuple:
    changed = edit(text, after)
    other = winnow(changed, k, w)
    return len(text), hashlib.sha256(changed.encode("utf-8")).hexdigest(), fp.digest(), other.digest(), likeness(own, other.distinct()), likeness(own, after_own)


def with_successor(docs: DataFrame, k: int = K, w: int = W, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text against its edited form and its successor by id (after the last: the first).

    One range shuffle puts the texts in order; within a partition successors
    are at hand. The last text of a partition meets the first of the next
    filled one through an equi-join of two texts per partition. Null texts are
    empty, null ids come first, rows of equal id follow by a hash of the text;
    a lone row is its own successor.
    """
    ordered = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("raw"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("tie")).repartitionByRange("id", "tie").sortWithinPartitions("id", "tie")
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, last = TaskContext.get().partitionId(), None

        def rows(out: list[tuple], what: str, id_type: pa.DataType) -> pa.RecordBatch:
            """Rows (id, raw or None, result or None)."""
            n = len(out)
            results = [pa.array([None if r[2] is None else r[2][i] for r in out], t) for i, t in enumerate(_RESULT_TYPES)]
            return pa.RecordBatch.from_arrays([pa.array([part] * n, pa.int32()), pa.array([what] * n, pa.string()), pa.array([r[0] for r in out], id_type), pa.array([r[1] for r in out], pa.string()), *results], ["part", "what", "id", "raw", *RESULT])

        for batch in batches:
            id_type = batch.column("id").type
            for piece in text_slices(batch, "raw"):
                done = []
                for key, text in zip(piece.column("id").to_pylist(), piece.column("raw").to_pylist(), strict=True):
                    fp = winnow(text, k, w)
                    own = fp.distinct()
                    if last is None:
                        yield rows([(key, text, None)], "first", id_type)
                    else:
                        done.append((last[0], None, _compare(last[1], last[2], last[3], text, own, k, w)))
                    last = (key, text, fp, own)
                yield rows(done, "whole", id_type)
        if last is not None:
            yield rows([(last[0], last[1], None)], "last", id_type)

    out = materialise(ordered.select("id", "raw").mapInArrow(run, f"part int, what string, id {kind}, raw string, {_RESULT_SQL}"))
    first = out.where("what = 'first'").select("part", F.col("raw").alias("after"))
    order = Window.orderBy("part")
    following = first.select("part").select("part", F.coalesce(F.lead("part").over(order), F.first("part").over(order)).alias("next_part"))
    ends = out.where("what = 'last'").select("part", "id", "raw").join(following, "part").join(first.withColumnRenamed("part", "next_part"), "next_part")

    def bridge(batch: pa.RecordBatch) -> pa.RecordBatch:
        results = []
        for text, after in zip(batch.column("raw").to_pylist(), batch.column("after").to_pylist(), strict=True):
            fp = winnow(text, k, w)
            results.append(_compare(text, fp, fp.distinct(), after, winnow(after, k, w).distinct(), k, w))
        return pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array([r[i] for r in results], t) for i, t in enumerate(_RESULT_TYPES))], ["id", *RESULT])

    bridged = map_texts(ends, ["id", "raw", "after"], "raw", f"id {kind}, {_RESULT_SQL}", bridge)
    return out.where("what = 'whole'").select("id", *RESULT).unionByName(bridged).withColumnRenamed("id", id_col)

"""Shared helpers of the training-data operators: tables, checkpoints, Arrow batches.

Conventions of all operators here: they select the columns they need by name,
so extra columns (also ones named like an output) are ignored; a null text is
the empty text; rows that repeat a document id are kept as rows of their own.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from foliary.batches import BATCH_BYTES, bound_batches  # noqa: F401

#: Text bytes handled at once inside a Python worker; bounds its memory.
SLICE_BYTES = 2 << 20
#: Most bits of a bitmap of marks (32 MiB).
MOST_MARK_BITS = 1 << 28
#: Whether Spark drops an execution's shuffle files when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Only in local mode, where driver and executor are one process, a temporary
    folder stands in for it if it is unset; on a cluster that is an error.
    """
    sc = spark.sparkContext
    known = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if known:
        return known.rstrip("/")
    current = sc.getCheckpointDir()
    if current is None:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        current = "file://" + tempfile.mkdtemp(prefix="foliary-checkpoint-")
        sc.setCheckpointDir(current)
    return current.rsplit("/", 1)[0] if current.count("/") > 4 else current


def fresh_dir(spark: SparkSession, kind: str) -> str:
    return f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder as Parquet and read them again: cuts lineage and survives lost executors.

    The shuffle files behind the written rows go at once, nothing reads them again.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, "stage")
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def few(df: DataFrame, rows: int, each: int) -> DataFrame:
    """The same rows in as many partitions as ``each`` rows ask for, where Spark has more: a small table then is a few files, not hundreds."""
    most = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(1, -(-rows // each))
    return df.coalesce(wanted) if wanted < most else df


def discard(*written: DataFrame) -> None:
    """Delete the files of materialised rows that no later step reads."""
    for df in written:
        jvm = df.sparkSession._jvm
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


def marks(rows: DataFrame, column: str) -> np.ndarray:
    """Bitmap in which the bit of each value of a bigint column is set: 16 bits a row, MOST_MARK_BITS at most.

    It spares most rows that an exact join drops later; where it is full it
    spares none and changes no result. Collected in pieces of 4 KiB.
    """
    bits = min(MOST_MARK_BITS, 1 << max(20, (16 * rows.count()).bit_length()))
    place = F.pmod(column, F.lit(bits))
    pieces = rows.select(F.floor(place / 32768).cast("int").alias("piece"), (place % 32768).alias("bit")).groupBy("piece").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()
    out = np.zeros(bits // 8, np.uint8)
    for r in pieces:
        out[r["piece"] * 4096 : r["piece"] * 4096 + len(r["bits"])] = np.frombuffer(r["bits"], np.uint8)
    return out


def marked(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether the bits of 64-bit values are set."""
    bit = values.view(np.uint64) & np.uint64(8 * len(bitmap) - 1)
    return (bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def text_slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each piece holds about SLICE_BYTES of the column."""
    total = batch.column(column).nbytes
    if total <= SLICE_BYTES or batch.num_rows < 2:
        yield batch
        return
    step = max(1, batch.num_rows * SLICE_BYTES // total)
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def _return_large_blocks() -> None:
    """Have the C library give freed blocks of 256 KB and more back to the system at once, and use one arena.

    By default it raises that bound with each large array that is freed and
    keeps up to 32 MB pieces, which adds up over long-lived workers.
    """
    with contextlib.suppress(OSError, AttributeError):
        c = ctypes.CDLL(None)
        c.mallopt(-3, 256 << 10)  # M_MMAP_THRESHOLD
        c.mallopt(-1, 1 << 20)  # M_TRIM_THRESHOLD
        c.mallopt(-8, 1)  # M_ARENA_MAX


if "pyspark.worker" in sys.modules:  # in workers, never in the driver
    _return_large_blocks()
_holder: tuple[str, Callable[[], None]] | None = None


def hold(name: str, release: Callable[[], None] = lambda: None) -> None:
    """Say which operator this worker works for; what the one before kept in memory is released.

    Spark reuses Python workers, so caches of one operator would otherwise stay
    beside those of the next.
    """
    global _holder
    if _holder is not None and _holder[0] == name:
        return
    if _holder is not None:
        _holder[1]()
        gc.collect()
        with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
            ctypes.CDLL(None).malloc_trim(0)
    _holder = (name, release)


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    return [x or "" for x in batch.column(column).to_pylist()]


def map_texts(df: DataFrame, columns: Iterable[str | Column], column: str, schema: str | StructType, work: Callable[[pa.RecordBatch], pa.RecordBatch]) -> DataFrame:
    """mapInArrow over the named columns, in slices of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_slices(batch, column):
                if piece.num_rows:
                    yield work(piece)

    bound_batches(df.sparkSession)
    return df.select(*columns).mapInArrow(run, schema)


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Groups of equal keys, one table each, from batches in which each key's rows follow one another."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            key = tuple(c[a] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)

"""Loading of tables, and registration of queries."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, kind: str) -> str:
    """A new folder that driver and executors share, below spark.checkpoint.dir; only in local mode one of the machine."""
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = f"file://{tempfile.gettempdir()}/foliary"
    return f"{base.rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def written(df: DataFrame, kind: str) -> DataFrame:
    """The rows, written out and read again: an iterative plan stays short and survives lost executors."""
    path = scratch(df.sparkSession, kind)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Registry:
    """Collects queries by the name of their function, with the SQL that says the same."""

    def __init__(self):
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def __call__(self, sql: str | None = None) -> Callable[[Query], Query]:
        def add(f: Query) -> Query:
            self.queries[f.__name__] = f
            if sql:
                self.sql[f.__name__] = sql
            return f

        return add

"""Parquet base tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Lazily read one base table. Callers select the columns they need right
    away, so the scan's ReadSchema holds only those columns."""
    if name not in TABLE_NAMES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(os.path.join(root, f"{name}.parquet"))


class Tables:
    """The base tables of one folder, each opened once, when it is first asked for.

    Opening a Parquet table lists its files and reads a schema, so what needs a
    table in several places of one plan shares one of these."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self._opened = spark, root, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._opened:
            self._opened[name] = read_table(self.spark, self.root, name)
        return self._opened[name]

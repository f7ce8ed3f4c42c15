"""Small helpers that several operators of this package share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.session import ensure_checkpoint_dir
from panelspark.sources.tables import read_table

#: A word: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, root, "documents")


def saved(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back: a lineage
    cut that survives the loss of executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own in the shared folder of the session."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Like ``saved``, as a compressed table: for what is large, and read in parts."""
    spark, path = df.sparkSession, new_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc32_mod(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as ''."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def text_hash(text: str) -> Column:
    """60 bits of md5 as a long, 0 for null: tells rows of one id apart by
    their text, and is expressible in other SQL engines."""
    return F.coalesce(F.conv(F.substring(F.md5(F.col(text).cast("binary")), 1, 15), 16, 10).cast("long"), F.lit(0))


def connected_components(edges: DataFrame) -> DataFrame:
    """Components of an undirected graph: (node, component) for every node of
    ``edges`` (columns a, b), component being the smallest node reachable.

    Alternating large-star and small-star steps: every node is linked to the
    smallest node it knows, which leaves a star per component after about the
    logarithm of the longest path. Each round is a few equi-joins and
    aggregations over the edges, cut with a reliable checkpoint. Null ends and
    loops are ignored; an empty input gives an empty result.
    """
    current = saved(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    state = _fingerprint(current)
    while state[0]:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        lower = large.join(smallest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = saved(lower.unionByName(smallest.select("u", F.col("m").alias("v"))).distinct())
        found = _fingerprint(after)
        if found == state:
            break
        current, state = after, found
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots).distinct()


def _fingerprint(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return int(row["n"]), int(row["s"] or 0)

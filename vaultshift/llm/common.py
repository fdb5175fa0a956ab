"""Shared helpers of the training-data operators: scratch tables, fold masks, connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 1_000_000


class Scratch:
    """Parquet tables below the cluster's shared folder, so that lost executors cost no recomputation.

    The folder is ``spark.checkpoint.dir`` as the session has it. Only a local master (tests) may do
    without it and gets a temporary folder. ``drop`` deletes a table that nothing reads any more.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
        if not root:
            if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            import tempfile

            root = tempfile.mkdtemp(prefix="vaultshift-scratch-")
            spark.sparkContext.setCheckpointDir(root)
        self.root = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, table: str) -> DataFrame:
        path = f"{self.root}/{table}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *tables: str) -> None:
        jvm = self.spark.sparkContext._jvm
        for t in tables:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{t}")
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def release(self) -> None:
        """Lets the driver find out now which finished shuffles nothing refers to, so that executors delete their
        files; by default it looks every half hour."""
        import gc

        gc.collect()
        self.spark.sparkContext._jvm.System.gc()


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most 1 000 rows from here on: a task holds one on either side of its Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text modulo ``modulus``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """Whether a written table has at most ``limit`` rows (a count from Parquet footers)."""
    return df.count() <= limit


def hint_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """The table with a broadcast hint if it has at most ``limit`` rows, else as it is (shuffle join)."""
    return F.broadcast(df) if small(df, limit) else df


def components(edges: DataFrame, scratch: Scratch, name: str = "cc") -> DataFrame:
    """Connected components: ``edges`` (a, b) of longs -> (node, comp), comp the least node reached.

    Alternating large-star and small-star steps until the edge set no longer changes. Every step is
    a partially aggregated ``min`` and a join (which AQE can split), so a node with many neighbours
    is never gathered in one group; nothing but two numbers a round reaches the driver.
    """
    def oriented(df):
        return df.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()

    cur = scratch.write(oriented(edges), f"{name}0")
    last, k = None, 0
    while True:
        state = tuple(cur.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == last or state[0] == 0:
            break
        last, k = state, k + 1
        low_hint = F.broadcast if state[0] <= BROADCAST_ROWS // 2 else (lambda df: df)  # least neighbours: at most two a link
        sym = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = sym.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = sym.join(low_hint(low), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = scratch.write(large, f"{name}{k}l")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(low_hint(low), "a")
        nxt = scratch.write(
            joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(low.select("a", F.col("m").alias("b"))).distinct(), f"{name}{k}")
        scratch.drop(f"{name}{k - 1}", f"{name}{k}l")
        cur = nxt
    out = cur.groupBy("a").agg(F.min("b").alias("comp")).withColumnRenamed("a", "node")
    return out.unionByName(out.select(F.col("comp").alias("node"), "comp").distinct())

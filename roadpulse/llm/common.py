"""Shared helpers of the text operators: session settings, table paths, components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.session import configure, materialize

# Texts can be long, so Python workers get few rows at once (applied only where the user set nothing).
BATCH_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(32 << 20),
}


def prepare(spark: SparkSession) -> SparkSession:
    configure(spark)
    for key, value in BATCH_CONF.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have (names are compared without case, as Spark does)."""
    taken = {c.lower() for c in df.columns}
    name = f"_{stem}"
    while name.lower() in taken:
        name = "_" + name
    return name


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Smallest member of each connected component: rows (node, root), nodes without edges left out.

    Alternating large-star and small-star rounds over the edge table until it no
    longer changes; every round is a grouped minimum and an equi-join, and is written
    to the shared folder, so lineage stays short and a lost executor costs one round.
    """
    cur = materialize(
        edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).where("hi <> lo").distinct(), "cc"
    )
    mark = None
    while True:
        # Large star: each node points its larger neighbours at its smallest neighbour.
        low = cur.groupBy(F.col("hi").alias("u")).agg(F.min("lo").alias("m"))
        large = (
            cur.join(low, cur.lo == low.u, "left")
            .select("hi", F.coalesce("m", "lo").alias("lo"))
            .distinct()
        )
        # Small star: each node points its smaller neighbours and itself at the smallest of them.
        low2 = large.groupBy(F.col("hi").alias("u")).agg(F.min("lo").alias("m"))
        both = large.join(low2, large.hi == low2.u).select(
            F.explode(F.array(F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")),
                              F.struct(F.col("hi").alias("hi"), F.col("m").alias("lo")))).alias("e")
        )
        cur = materialize(both.select("e.hi", "e.lo").where("hi <> lo").distinct(), "cc")
        now = cur.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            return cur.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(
                cur.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
            )
        mark = tuple(now)

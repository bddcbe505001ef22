"""Weighted PageRank."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.util import drop_path
from ..session import ensure_checkpoint_dir


def normalized_edges(edges: DataFrame, by_degree: bool = False) -> DataFrame:
    """A14 + J10: each edge weight divided by its source's total out-weight
    (and, with ``by_degree``, also by the source's out-degree)."""
    sums = edges.groupBy("src").agg(F.sum("weight").alias("_total"), F.count(F.lit(1)).alias("_deg"))
    # a source whose weights sum to zero has no usable transitions (null, not an error)
    w = F.try_divide(F.col("weight"), F.col("_total"))
    if by_degree:
        w = w / F.col("_deg")
    return edges.join(sums, "src").select("src", "dst", w.alias("w"))


def weighted_pagerank(edges: DataFrame, iterations: int = 10, damping: float = 0.85,
                      digits: int | None = None, by_degree: bool = False,
                      checkpoint_every: int = 5) -> DataFrame:
    """r0 = 1/N; r <- (1-d)/N + d * sum over in-edges of r(src) * w.

    Normalised edges are computed once and cached. Each round is one join
    (edges ⋈ ranks on source) and one aggregation: the contributions are
    unioned with a zero row per vertex, so vertices without in-links keep the
    teleport share without a second join. Every few rounds, and after the last
    one, the ranks are written as a table into the session's shared checkpoint
    folder (``spark.checkpoint.dir``) and read back, which cuts the lineage with
    a single job per cut; the table before it is deleted. The returned ranks depend on no cached data.
    """
    spark = edges.sparkSession
    ensure_checkpoint_dir(spark)
    given = edges.persist()          # read by both sides of the normalisation join
    # cached as computed, not pre-partitioned by source: each round's join then
    # goes through a shuffle that adaptive execution can split when one source
    # vertex (a hub) owns a large share of the edges, or skips entirely by
    # broadcasting the rank vector when its measured size is small
    e = normalized_edges(given, by_degree).persist()
    vertices = e.select(F.col("src").alias("vertex")).union(e.select(F.col("dst").alias("vertex"))) \
        .distinct().persist()
    n = vertices.select(F.count(F.lit(1)).cast("double")).scalar()
    zero = vertices.select("vertex", F.lit(0.0).alias("c"))
    ranks = vertices.select("vertex", (F.lit(1.0) / n).alias("rank"))
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pagerank-{uuid.uuid4().hex}"
    written = None
    for i in range(iterations):
        contrib = (e.join(ranks.withColumnRenamed("vertex", "src"), "src")
                   .select(F.col("dst").alias("vertex"), (F.col("rank") * F.col("w")).alias("c")))
        ranks = (contrib.unionByName(zero).groupBy("vertex")
                 .agg((F.first(F.lit(1 - damping) / n) + F.lit(damping) * F.sum("c")).alias("rank")))
        if (i + 1) % checkpoint_every == 0 or i + 1 == iterations:
            # cut the lineage: one job writes the ranks into the shared checkpoint
            # folder, later rounds read them back from there
            path = f"{base}/round-{i + 1}"
            ranks.write.mode("overwrite").parquet(path)
            ranks = spark.read.parquet(path)
            if written:
                drop_path(spark, written)        # nothing reads the earlier round any more
            written = path
    if iterations == 0:
        ranks.write.parquet(f"{base}/round-0")
        ranks = spark.read.parquet(f"{base}/round-0")
    # the result reads only the written ranks: release the caches
    given.unpersist()
    e.unpersist()
    vertices.unpersist()
    if digits is not None:
        ranks = ranks.select("vertex", F.round("rank", digits).alias("rank"))
    return ranks

"""Edge-list source and vertex-result sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import EDGE


def read_edges(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated (src, dst, weight)."""
    return spark.read.schema(EDGE).option("sep", "\t").option("mode", "FAILFAST").csv(path)


def write_tsv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Tab-separated result rows (e.g. vertex, rank)."""
    df.write.mode(mode).option("sep", "\t").csv(path)

"""Show how a hot key is spread by the keyed scan.

A third of the car events (derived from the events table) are re-labelled to
one car. The per-car ordered rank is computed twice: with a plain window per
car, and with ``keyed_scan``, which deals the rows out by ranges of (car, time).
Prints the rows handled by the busiest task and the number of tasks that hold
rows of the hot car.

usage: python scripts/skew_check.py [sf_dir]
"""

from __future__ import annotations

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tripstream.plans.prefix import keyed_scan  # noqa: E402
from tripstream.session import get_spark  # noqa: E402
from tripstream.sources import fixtures as fx  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_spark(shuffle_partitions=64, extra={"spark.sql.adaptive.enabled": "false"})
    ev = fx.car_events(spark, sf_dir).withColumn(
        "carId", F.when(F.col("id").cast("long") % 3 == 0, F.lit("hot")).otherwise(F.col("carId")))
    hot_rows = ev.filter(F.col("carId") == "hot").count()

    def spread(df):
        per = (df.groupBy(F.spark_partition_id().alias("p"))
               .agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("carId") == "hot", 1).otherwise(0)).alias("h"),
                    F.max("rank").alias("r"))      # keeps the window in the plan
               .collect())
        return {"max_rows_per_task": max(r.n for r in per),
                "tasks_with_hot_rows": sum(1 for r in per if r.h > 0)}

    plain = ev.withColumn("rank", F.count(F.lit(1)).over(
        Window.partitionBy("carId").orderBy("eventTime", "id").rowsBetween(Window.unboundedPreceding, 0)))
    scanned = keyed_scan(ev, ["carId"], ["eventTime", "id"], None, {"rank": ("count", F.lit(1))})
    same = plain.select("id", "rank").exceptAll(scanned.select("id", "rank")).count() == 0
    print(json.dumps({"rows": ev.count(), "hot_rows": hot_rows,
                      "plain_window": spread(plain), "keyed_scan": spread(scanned),
                      "same_ranks": same}))


if __name__ == "__main__":
    main()

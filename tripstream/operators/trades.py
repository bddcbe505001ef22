"""Trade enrichment with customer data (J3 as-of, J4 latest-received), batch form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.prefix import duration_bucket, keyed_scan


def _enrich(trades: DataFrame, customers: DataFrame, order_col, bucket: str | None,
            trade_order=None) -> DataFrame:
    # One stream of both sides; at equal order value customers come first, so a
    # customer update at the trade's own time is used ("equal time matches").
    t_order = trade_order if trade_order is not None else F.col(order_col)
    t = trades.select(t_order.alias("_o"), "customerId", "eventTime", "tradeInfo",
                      F.lit(1).alias("_side"), F.lit(None).cast("struct<customerTime: timestamp, customerInfo: string>").alias("_cust"))
    c = customers.select(F.col(order_col).alias("_o"), "customerId",
                         F.col("eventTime"), F.lit(None).cast("string").alias("tradeInfo"),
                         F.lit(0).alias("_side"),
                         F.struct(F.col("eventTime").alias("customerTime"), "customerInfo").alias("_cust"))
    both = t.unionByName(c)
    scanned = keyed_scan(both, ["customerId"], ["_o", "_side", "tradeInfo", "_cust"],
                         duration_bucket("_o", bucket),
                         {"_match": ("last", F.col("_cust"))}, inclusive=True)
    return (scanned.filter(F.col("_side") == 1)
            .select("eventTime", "customerId", "tradeInfo",
                    F.col("_match.customerTime").alias("customerTime"),
                    F.col("_match.customerInfo").alias("customerInfo")))


def asof_join(trades: DataFrame, customers: DataFrame, bucket: str | None = None) -> DataFrame:
    """Each trade with the newest customer row whose time is <= the trade time
    (null if none). Skew-safe: no per-customer task, no range blow-up."""
    return _enrich(trades, customers, "eventTime", bucket)


def latest_join(trades: DataFrame, customers: DataFrame, arrival: str = "eventTime",
                bucket: str | None = None, delay: str | None = None) -> DataFrame:
    """Each trade with the customer row received last before it, by the
    ``arrival`` column present on both sides (arrival order is an input in batch).

    With ``delay`` (the watermark delay of the stream form), a trade that finds no
    customer waits: it takes the last customer received by its own event time
    plus the delay, i.e. when the watermark passed it. That second lookup runs
    only over the trades still unmatched, so no pairing of rows is needed."""
    first = _enrich(trades, customers, arrival, bucket)
    if delay is None:
        return first
    matched = first.filter(F.col("customerTime").isNotNull())
    waiting = first.filter(F.col("customerTime").isNull()).select("eventTime", "customerId", "tradeInfo")
    late = F.col("eventTime") + F.expr(f"INTERVAL {delay}")
    second = _enrich(waiting, customers, arrival, bucket, trade_order=late)
    return matched.unionByName(second)

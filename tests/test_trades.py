import datetime as dt

from tripstream import operators as op
from tripstream.schemas import CUSTOMER, TRADE

T0 = dt.datetime(2021, 1, 1)


def ms(v):
    return T0 + dt.timedelta(milliseconds=v)


def run(spark, trades, customers, fn=op.asof_join):
    t = spark.createDataFrame([(ms(a), 0, f"trade-{a}") for a in trades], TRADE)
    c = spark.createDataFrame([(ms(a), 0, f"customer-{a}") for a in customers], CUSTOMER)
    return sorted((r.tradeInfo, r.customerInfo) for r in fn(t, c, bucket="1 second").collect())


def test_customer_before_trade(spark):
    assert run(spark, [1000], [0, 500, 1500]) == [("trade-1000", "customer-500")]


def test_trade_later_and_equal_time(spark):
    assert run(spark, [1200, 1500], [500, 1500]) == [("trade-1200", "customer-500"),
                                                     ("trade-1500", "customer-1500")]


def test_many_pending_trades(spark):
    assert run(spark, [1700, 1800, 2000], [1600, 2100]) == [
        ("trade-1700", "customer-1600"), ("trade-1800", "customer-1600"), ("trade-2000", "customer-1600")]


def test_no_customer_yet(spark):
    assert run(spark, [100], [200]) == [("trade-100", None)]


def test_latest_join_same_on_event_order(spark):
    assert run(spark, [1200, 1500], [500, 1500], op.latest_join) == [
        ("trade-1200", "customer-500"), ("trade-1500", "customer-1500")]


def test_latest_join_waits_for_watermark_when_no_customer_yet(spark):
    """Arrival order differs from event time: the trade arrives before any customer;
    with a 500 ms delay it takes the customer that arrived by its time + delay."""
    t = spark.createDataFrame([(ms(1000), 0, "trade-1000", ms(1000))],
                              "eventTime timestamp, customerId long, tradeInfo string, arrival timestamp")
    c = spark.createDataFrame([(ms(900), 0, "customer-900", ms(1300)), (ms(950), 0, "customer-950", ms(1700))],
                              "eventTime timestamp, customerId long, customerInfo string, arrival timestamp")
    plain = op.latest_join(t, c, arrival="arrival").collect()
    assert [(r.tradeInfo, r.customerInfo) for r in plain] == [("trade-1000", None)]
    waited = op.latest_join(t, c, arrival="arrival", delay="0.5 seconds").collect()
    assert [(r.tradeInfo, r.customerInfo) for r in waited] == [("trade-1000", "customer-900")]

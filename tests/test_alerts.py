from conftest import ride, rides_df
from tripstream import operators as op


def ids(df):
    return sorted(r.rideId for r in df.collect())


def test_short_ride_and_out_of_order(spark):
    assert ids(op.long_rides(rides_df(spark, [ride(1, True, 0), ride(1, False, 0, 1)]))) == []
    assert ids(op.long_rides(rides_df(spark, [ride(1, False, 0, 1), ride(1, True, 0)]))) == []


def test_missing_start_is_not_reported(spark):
    assert ids(op.long_rides(rides_df(spark, [ride(1, False, 0, 1)]))) == []


def test_missing_end_and_long_ride(spark):
    assert ids(op.long_rides(rides_df(spark, [ride(1, True, 0)]))) == [1]
    assert ids(op.long_rides(rides_df(spark, [ride(1, True, 0), ride(1, False, 0, 180)]))) == [1]


def test_boundary_end_exactly_at_limit(spark):
    df = rides_df(spark, [ride(1, True, 0), ride(1, False, 0, 120)])
    assert ids(op.long_rides(df)) == []
    assert ids(op.long_rides_pattern(df)) == [1]

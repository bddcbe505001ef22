"""Fixed record schemas of the ride, fare, car-event, trade/customer, mail and edge data."""

from pyspark.sql import types as T

RIDE_COLUMNS = ["rideId", "taxiId", "driverId", "isStart", "startTime", "endTime",
                "eventTime", "startLon", "startLat", "endLon", "endLat", "passengerCnt"]

# Raw CSV ride record: rideId, START/END, time1, time2, 4 coordinates, passengerCnt, taxiId, driverId.
# For END lines time1 is the end time and time2 the start time.
RIDE_CSV = T.StructType([
    T.StructField("rideId", T.LongType()),
    T.StructField("kind", T.StringType()),
    T.StructField("time1", T.StringType()),
    T.StructField("time2", T.StringType()),
    T.StructField("startLon", T.StringType()),
    T.StructField("startLat", T.StringType()),
    T.StructField("endLon", T.StringType()),
    T.StructField("endLat", T.StringType()),
    T.StructField("passengerCnt", T.ShortType()),
    T.StructField("taxiId", T.LongType()),
    T.StructField("driverId", T.LongType()),
])

FARE_CSV = T.StructType([
    T.StructField("rideId", T.LongType()),
    T.StructField("taxiId", T.LongType()),
    T.StructField("driverId", T.LongType()),
    T.StructField("startTime", T.StringType()),
    T.StructField("paymentType", T.StringType()),
    T.StructField("tip", T.StringType()),
    T.StructField("tolls", T.StringType()),
    T.StructField("totalFare", T.StringType()),
])

RIDE = T.StructType([
    T.StructField("rideId", T.LongType()),
    T.StructField("taxiId", T.LongType()),
    T.StructField("driverId", T.LongType()),
    T.StructField("isStart", T.BooleanType()),
    T.StructField("startTime", T.TimestampType()),
    T.StructField("endTime", T.TimestampType()),
    T.StructField("eventTime", T.TimestampType()),
    T.StructField("startLon", T.FloatType()),
    T.StructField("startLat", T.FloatType()),
    T.StructField("endLon", T.FloatType()),
    T.StructField("endLat", T.FloatType()),
    T.StructField("passengerCnt", T.ShortType()),
])

FARE = T.StructType([
    T.StructField("rideId", T.LongType()),
    T.StructField("taxiId", T.LongType()),
    T.StructField("driverId", T.LongType()),
    T.StructField("startTime", T.TimestampType()),
    T.StructField("paymentType", T.StringType()),
    T.StructField("tip", T.DoubleType()),
    T.StructField("tolls", T.DoubleType()),
    T.StructField("totalFare", T.DoubleType()),
])

CAR_EVENT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("carId", T.StringType()),
    T.StructField("eventTime", T.TimestampType()),
    T.StructField("longitude", T.FloatType()),
    T.StructField("latitude", T.FloatType()),
    T.StructField("consumption", T.FloatType()),
    T.StructField("speed", T.DoubleType()),
    T.StructField("throttle", T.DoubleType()),
    T.StructField("engineload", T.FloatType()),
])

MAIL_FIELDS = ["messageId", "time", "sender", "subject", "body", "replyTo"]
MAIL = T.StructType([T.StructField(n, T.StringType()) for n in MAIL_FIELDS])

EDGE = T.StructType([
    T.StructField("src", T.StringType()),
    T.StructField("dst", T.StringType()),
    T.StructField("weight", T.DoubleType()),
])

TRADE = T.StructType([
    T.StructField("eventTime", T.TimestampType()),
    T.StructField("customerId", T.LongType()),
    T.StructField("tradeInfo", T.StringType()),
])

CUSTOMER = T.StructType([
    T.StructField("eventTime", T.TimestampType()),
    T.StructField("customerId", T.LongType()),
    T.StructField("customerInfo", T.StringType()),
])

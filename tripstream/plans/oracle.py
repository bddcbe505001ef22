"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each text is self-contained: the derived views of FIXTURES.md §4 are CTEs over
the generated tables, and the grid/distance functions are spelled out inline.
"""

from __future__ import annotations

# Fixed values of the grid and the mail terms, spelled out here on their own so
# that the oracle does not follow the code under test.
LON_EAST, LON_WEST, LAT_NORTH, LAT_SOUTH = -73.7, -74.05, 41.0, 40.5
DELTA_LON, DELTA_LAT, GRID_X = 0.0014, 0.00125, 250
STOP_WORDS = (
    "the", "i", "a", "an", "at", "are", "am", "for", "and", "or", "is",
    "there", "it", "this", "that", "on", "was", "by", "of", "to", "in",
    "to", "message", "not", "be", "with", "you", "have", "as", "can",
)

#: Arrival of an event at the join: up to an hour after its own time.
ARRIVAL = "(ts + to_seconds(cast(event_id * 7919 % 3600 as bigint)))"
ONGOING_QUERIES = [(1, 30, "2024-01-15 12:00:00"), (2, 0, "2024-01-08 00:00:00"), (3, 600, "2024-01-28 06:30:00")]
#: Location queries with their arrival: two live until a purge (longitude 0), one of
#: a quarter of an hour, one until the last arrives, the last for ever.
TIMED_QUERIES = [(1, -74.0, 41.0, "2024-01-02 00:00:00"), (2, -73.7781, 40.6413, "2024-01-02 00:10:00"),
                 (3, 0.0, 0.0, "2024-01-12 06:00:00"), (4, -73.95, 40.7, "2024-01-19 00:00:00"),
                 (5, -73.85, 40.6, "2024-01-19 00:15:00"), (6, -73.977664, 40.761484, "2024-01-19 00:15:01")]
#: The cell of the registered single-cell arrivals.
CELL = 103978
AS_OF = "2024-01-15 12:00:00"
MAIL_EXCLUDE = ("user0@example.org",)
RULE_PREDICATE = "isStart and passengerCnt > 3"

_PLUS = "(ts + to_seconds(cast(floor(value * 60) as bigint)))"

RIDES = f"""rides AS (
  select event_id as rideId, user_id as taxiId, event_id % 97 as driverId, b.isStart,
    ts as startTime,
    case when b.isStart then timestamp '1970-01-01 00:00:00' else {_PLUS} end as endTime,
    case when b.isStart then ts else {_PLUS} end as eventTime,
    cast(-74.08 + (event_id % 7) * 0.06 as float) as startLon,
    cast(40.48 + (event_id % 5) * 0.12 as float) as startLat,
    cast(-74.08 + (event_id % 11) * 0.037 as float) as endLon,
    cast(40.48 + (event_id % 3) * 0.2 as float) as endLat,
    cast(1 + event_id % 6 as smallint) as passengerCnt
  from events cross join (select true as isStart union all select false as isStart) b)"""

FARES = """fares AS (
  select event_id as rideId, user_id as taxiId, event_id % 97 as driverId, ts as startTime,
    case when event_id % 3 = 0 then 'CSH' else 'CRD' end as paymentType,
    value / 10 as tip, cast(event_id % 4 as double) as tolls, value as totalFare
  from events where event_id % 13 <> 0)"""

CARS = """car_events AS (
  select cast(event_id as varchar) as id, concat('car', cast(user_id as varchar)) as carId,
    ts as eventTime, case when event_id % 7 = 0 then 0.0 else value end as speed,
    value / 20 as throttle
  from events)"""

TRADES = """trades AS (
  select ts as eventTime, user_id as customerId, concat('trade-', cast(event_id as varchar)) as tradeInfo
  from events where event_type = 'purchase')"""

CUSTOMERS = """customers AS (
  select ts as eventTime, user_id as customerId, concat('customer-', cast(event_id as varchar)) as customerInfo
  from events where event_type = 'signup')"""

ITEMS = """items AS (select event_id as seq, event_type as shape, user_id % 10 as color from events)"""

MAILS = """mails AS (
  select concat(cast(conv_id as varchar), '-', cast(turn as varchar)) as messageId,
    concat('2015-', lpad(cast(1 + conv_id % 12 as varchar), 2, '0'), '-05-10:00:00') as time,
    concat('User ', role, ' <', role, cast((conv_id + turn) % 9 as varchar), '@example.org>') as sender,
    concat('thread ', cast(conv_id as varchar)) as subject, text as body,
    case when turn = 0 then 'null' else concat(cast(conv_id as varchar), '-', cast(turn - 1 as varchar)) end as replyTo
  from conversations)"""

EDGES = """edges AS (
  select cast(c_nationkey as varchar) as src, cast(s_nationkey as varchar) as dst, sum(l_quantity) as weight
  from lineitem join orders on l_orderkey = o_orderkey
    join customer on o_custkey = c_custkey join supplier on l_suppkey = s_suppkey
  group by 1, 2)"""


def _d(x: str) -> str:
    return f"cast({x} as double)"


def nyc(lon: str, lat: str) -> str:
    return (f"({_d(lon)} between {LON_WEST}::double and {LON_EAST}::double and "
            f"{_d(lat)} between {LAT_SOUTH}::double and {LAT_NORTH}::double)")


def cell(lon: str, lat: str) -> str:
    return (f"cast(floor(({abs(LON_WEST)}::double - abs({_d(lon)})) / {DELTA_LON}::double)"
            f" + floor(({LAT_NORTH}::double - {_d(lat)}) / {DELTA_LAT}::double) * {GRID_X} as integer)")


def cell_lon(c: str) -> str:
    return (f"(-cast({abs(LON_WEST)}::double - ({c} % {GRID_X}) * {DELTA_LON}::double"
            f" - {DELTA_LON / 2}::double as float))")


def cell_lat(c: str) -> str:
    return (f"cast({LAT_NORTH}::double - cast(({c} - {c} % {GRID_X}) / {GRID_X} as integer)"
            f" * {DELTA_LAT}::double - {DELTA_LAT / 2}::double as float)")


def dist(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    x = f"cast(cast({lat1} as float) - cast({lat2} as float) as double)"
    y = f"(cast(cast({lon1} as float) - cast({lon2} as float) as double) * cos({_d(lat2)}))"
    return f"(110.25::double * sqrt({x} * {x} + {y} * {y}))"


def angle(slon: str, slat: str, dlon: str, dlat: str) -> str:
    x = f"cast(cast({dlat} as float) - cast({slat} as float) as double)"
    y = f"(cast(cast({dlon} as float) - cast({slon} as float) as double) * cos({_d(slat)}))"
    return f"(cast(trunc(degrees(atan2({x}, {y}))) as integer) + 179)"


def addr(s: str) -> str:
    t = f"regexp_extract({s}, '[^<]*$')"
    return f"substr({t}, 1, length({t}) - 1)"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _latest(where: str) -> str:
    return (f"(select * exclude (rn) from (select *, row_number() over (partition by taxiId "
            f"order by eventTime desc, (not isStart) desc, rideId desc) as rn from rides where {where}) "
            f"where rn = 1)")


def _hop(size_h: int, slide_h: int, cmp: str, threshold: int, with_start: bool) -> str:
    k = size_h // slide_h
    start = "ws as windowStart, " if with_start else ""
    return with_(RIDES, f"""c AS (select case when isStart then {cell('startLon', 'startLat')}
           else {cell('endLon', 'endLat')} end as cell, isStart, eventTime
         from rides where {nyc('startLon', 'startLat')} and {nyc('endLon', 'endLat')})""",
                 f"""w AS (select cell, isStart,
           time_bucket(interval {slide_h} hour, eventTime, timestamp '1970-01-01')
             - to_hours(cast({slide_h} * k as bigint)) as ws
         from c cross join (select unnest(range({k})) as k) t)""") + f"""
select {cell_lon('cell')} as lon, {cell_lat('cell')} as lat, {start}
       ws + interval {size_h} hour as windowEnd, isStart, count(*) as cnt
from w group by cell, isStart, ws having count(*) {cmp} {threshold}"""


def _segments(between: bool) -> str:
    prev = (", max(case when speed = 0 then eventTime end) over (partition by carId order by eventTime, id "
            "rows between unbounded preceding and current row) as prevStop") if between else ""
    cond = " and prevStop is not null" if between else ""
    return with_(CARS, f"""s AS (select *, min(case when speed = 0 then eventTime end) over (
        partition by carId order by eventTime range between current row and unbounded following) as stopTime
        {prev} from car_events)""") + f"""
select carId, stopTime, count(*) as length, min(eventTime) as startTime,
  cast(trunc(max(speed)) as integer) as maxSpeed, round(stddev_pop(throttle), 6) as erraticness,
  case cast(trunc(stddev_pop(throttle) / 2.5) as integer) when 0 then 'calm' when 1 then 'busy'
    else 'crazy' end as erraticnessDesc
from s where eventTime < stopTime{cond} group by carId, stopTime"""


def _long(strict: bool, clean: bool) -> str:
    src = f"(select * from rides where {nyc('startLon', 'startLat')} and {nyc('endLon', 'endLat')})" \
        if clean else "rides"
    op = "<" if strict else "<="
    return with_(RIDES, f"r AS (select * from {src})") + f"""
select s.* from r s where s.isStart and not exists (
  select 1 from r e where not e.isStart and e.rideId = s.rideId
    and e.eventTime {op} s.eventTime + interval 120 minute)"""


def _pagerank(iterations: int, damping: float, digits: int) -> str:
    ctes = [EDGES,
            "s AS (select src, sum(weight) as total from edges group by src)",
            "e AS (select edges.src, edges.dst, edges.weight / s.total as w from edges join s using (src))",
            "v AS (select src as vertex from e union select dst as vertex from e)",
            "nn AS (select cast(count(*) as double) as n from v)",
            "r0 AS (select vertex, 1.0::double / n as rank from v, nn)"]
    for i in range(1, iterations + 1):
        ctes.append(
            f"r{i} AS (select v.vertex, (1 - {damping}::double) / n + {damping}::double * coalesce(c.s, 0.0::double) as rank "
            f"from v cross join nn left join (select e.dst, sum(r.rank * e.w) as s from e join r{i - 1} r "
            f"on e.src = r.vertex group by e.dst) c on c.dst = v.vertex)")
    return with_(*ctes) + f"select vertex, round(rank, {digits}) as rank from r{iterations}"


def _stop_list() -> str:
    return ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))


def _tf_idf(source_cte: str | None, table: str, id_col: str, text_col: str) -> str:
    ctes = [source_cte] if source_cte else []
    ctes += [
        f"w AS (select {id_col} as docId, unnest(regexp_split_to_array(lower({text_col}), '[ \\t\\n\\r\\f]+')) as word from {table})",
        f"tf AS (select docId, word, count(*) as tf from w where regexp_full_match(word, '[a-z]+') "
        f"and word not in ({_stop_list()}) group by 1, 2)",
        "df AS (select word, count(*) as df from tf group by 1)",
        f"n AS (select cast(count(*) as double) as n from {table})",
    ]
    return with_(*ctes) + f"select tf.docId as {id_col}, tf.word, tf.tf * (n.n / df.df) as tfIdf " \
                          f"from tf join df using (word) cross join n"


def _route_heatmap() -> str:
    """F4 as a recursive CTE: one row per walk step of every cleansed START ride."""
    def gx(lon):
        return f"cast(floor(({abs(LON_WEST)}::double - abs({_d(lon)})) / {DELTA_LON}::double) as bigint)"

    def gy(lat):
        return f"cast(floor(({LAT_NORTH}::double - {_d(lat)}) / {DELTA_LAT}::double) as bigint)"
    pts = f"""p AS (select rideId, {gx('startLon')} as x1, {gy('startLat')} as y1,
        {gx('endLon')} as x2, {gy('endLat')} as y2
      from rides where isStart and {nyc('startLon', 'startLat')} and {nyc('endLon', 'endLat')})"""
    base = """b AS (select rideId,
        case when x1 <= x2 then x1 else x2 end as sx, case when x1 <= x2 then y1 else y2 end as sy,
        case when x1 <= x2 then x2 else x1 end as ex, case when x1 <= x2 then y2 else y1 end as ey
      from p)"""
    base2 = """b2 AS (select *, (ey - sy) / ((ex - sx) + 0.00000001::double) as slope from b)"""
    run = ("((cx < ex or cy <> ey) and not (cx > ex or (slope > 0 and cy > ey) "
           "or (not (slope > 0) and cy < ey)))")
    step = f"""walk(rideId, cx, cy, sx, sy, ex, ey, slope) AS (
      select rideId, sx, sy, sx, sy, ex, ey, slope from b2
      union all
      select rideId,
        case when slope > 0 then (case when near or yy < cy then cx + 1 else cx end)
             else (case when yy > cy + d then cx + d1 + 1 else cx + d1 end) end,
        case when slope > 0 then (case when near then cy + 1 when yy < cy then cy else cy + 1 end)
             else (case when yy > cy + d then cy + d else cy + d - 1 end) end,
        sx, sy, ex, ey, slope
      from (select *, case when near then 1 else 0 end as d1, case when near then -1 else 0 end as d
            from (select *, (yy > cy - 0.05::double and yy < cy + 0.05::double) as near
                  from (select *, (cx - sx + 0.5::double) * slope + sy
                                  + (case when slope > 0 then -0.5::double else 0.5::double end) as yy
                        from walk where {run})))
    )"""
    return ("WITH RECURSIVE " + ",\n".join([RIDES, pts, base, base2, step]) +
            f"\nselect cast(cx + cy * {GRID_X} as integer) as cell, count(*) as cnt from walk group by 1")


def oracle_sql() -> dict[str, str]:
    T = f"timestamp '{AS_OF}'"
    ex = ", ".join(f"'{a}'" for a in MAIL_EXCLUDE)
    q = {}
    q["clean_rides"] = with_(RIDES) + f"select * from rides where {nyc('startLon', 'startLat')} and {nyc('endLon', 'endLat')}"
    q["popular_places"] = _hop(12, 4, ">=", 5, with_start=False)
    q["popular_places_sql"] = _hop(12, 4, ">", 5, with_start=True)
    q["ride_count"] = with_(RIDES) + "select driverId, count(*) as cnt from rides group by driverId"
    q["enrich_rides"] = with_(RIDES, FARES) + """
select r.*, f.taxiId as fareTaxiId, f.driverId as fareDriverId, f.startTime as fareStartTime,
  f.paymentType, f.tip, f.tolls, f.totalFare
from rides r join fares f on r.rideId = f.rideId where r.isStart"""
    q["unmatched_fares"] = with_(RIDES, FARES) + """
select * from fares f where not exists (
  select 1 from rides r where r.isStart and r.rideId % 1000 <> 0 and r.rideId = f.rideId)"""
    q["unmatched_rides"] = with_(RIDES, FARES) + """
select * from rides r where r.isStart and r.rideId % 1000 <> 0
  and not exists (select 1 from fares f where f.rideId = r.rideId)"""
    q["fares_in_city"] = with_(RIDES, FARES) + f"""
select f.rideId, f.driverId, f.totalFare from rides r join fares f on r.rideId = f.rideId
where {nyc('r.startLon', 'r.startLat')} and {nyc('r.endLon', 'r.endLat')}"""
    q["catalog_fares_in_city"] = q["fares_in_city"]
    q["tsv_edges"] = with_(EDGES) + "select src, dst, cast(weight as double) as weight from edges"
    q["hourly_tip_leader"] = with_(RIDES, FARES, """h AS (
  select time_bucket(interval 6 hour, startTime, timestamp '1970-01-01') + interval 6 hour as windowEnd,
    driverId, round(sum(tip), 6) as tips from fares group by 1, 2)""") + """
select windowEnd, driverId, tips from (select *, row_number() over (
  partition by windowEnd order by tips desc, driverId asc) as rn from h) where rn = 1"""
    q["high_tip_hours"] = with_(FARES) + """
select time_bucket(interval 24 hour, startTime, timestamp '1970-01-01') + interval 24 hour as windowEnd,
  driverId, round(sum(tip), 6) as tips
from fares group by 1, 2 having sum(tip) > 10"""
    q["long_rides"] = _long(strict=False, clean=False)
    q["long_rides_clean"] = _long(strict=False, clean=True)
    q["long_rides_pattern"] = _long(strict=True, clean=False)
    sec = "date_trunc('second', {0}) as {0}"
    whole = ", ".join(sec.format(c) for c in ("startTime", "endTime", "eventTime"))
    q["ride_lines"] = with_(RIDES) + f"select * replace ({whole}) from rides"
    q["raw_trips"] = q["ride_lines"]
    q["raw_fares"] = with_(FARES) + f"select * replace ({sec.format('startTime')}) from fares"
    q["car_lines"] = with_(CARS) + f"""select id, carId, {sec.format('eventTime')},
  8.5::float as longitude, 47.25::float as latitude, 0::float as consumption, speed::float::double as speed,
  throttle::float::double as throttle, 0::float as engineload from car_events"""
    q["mail_records"] = with_(MAILS) + "select * from mails"
    q["mbox_mails"] = with_(MAILS) + """select * replace (chr(10) || rtrim(body, chr(10)) || chr(10) as body) from mails"""
    q["latest_per_taxi"] = with_(RIDES) + f"select * from {_latest('true')}"
    q["ongoing_rides_for_queries"] = " union all ".join(
        f"""(with {RIDES} select {n}::bigint as queryId, * from {_latest(f"eventTime <= timestamp '{at}'")}
where isStart and floor((epoch_ms(timestamp '{at}') - epoch_ms(eventTime)) / 60000) >= {minutes})"""
        for n, minutes, at in ONGOING_QUERIES)
    q["ongoing_rides"] = with_(RIDES) + f"""select * from {_latest(f'eventTime <= {T}')}
where isStart and floor((epoch_ms({T}) - epoch_ms(eventTime)) / 60000) >= 30"""
    q["nearest_taxi"] = with_(RIDES, """q AS (select * from (values (1::bigint, -74.0::double, 41.0::double),
      (2::bigint, -73.7781::double, 40.6413::double), (3::bigint, -73.977664::double, 40.761484::double)) t(queryId, qLon, qLat))""",
                              f"""d AS (select q.queryId, r.eventTime, r.rideId, r.taxiId,
      cast({dist('q.qLon', 'q.qLat', 'r.endLon', 'r.endLat')} as float) as km
    from rides r cross join q where not r.isStart)""",
                              """m AS (select *, min(km) over (partition by queryId order by eventTime, rideId
      rows between unbounded preceding and 1 preceding) as prev from d)""") + """
select queryId, eventTime, rideId, taxiId, km from m where prev is null or km < prev"""
    timed = ", ".join(f"({i}::bigint, {lon}::double, {lat}::double, timestamp '{at}')" for i, lon, lat, at in TIMED_QUERIES)
    q["nearest_taxi_ttl"] = "WITH RECURSIVE " + ",\n".join([RIDES, f"""q AS (select * from (values {timed}) t(queryId, qLon, qLat, since))""",
        """live AS (select *, (select min(n.since) from q n where n.since > q.since + interval 15 minute) as till from q where qLon <> 0)""",
        f"""d AS (select *, row_number() over (partition by queryId order by eventTime, rideId) as n from (
    select l.queryId, r.eventTime, r.rideId, r.taxiId, cast({dist('l.qLon', 'l.qLat', 'r.endLon', 'r.endLat')} as float) as km
    from rides r join live l on not r.isStart and r.eventTime >= l.since and (l.till is null or r.eventTime < l.till)))""",
        """far AS (select queryId, n, min(n) over (partition by queryId order by eventTime
      range between interval '28800000001 microseconds' following and unbounded following) as late from d)""",
        """c AS (select * from d where n = 1
  union all
  select e.* from c join far f on f.queryId = c.queryId and f.n = c.n
    join d e on e.queryId = c.queryId and e.n = (select min(b.n) from d b where b.queryId = c.queryId and b.n > c.n
      and (b.km < c.km or b.n = f.late)))"""]) + """
select queryId, eventTime, rideId, taxiId, km from c"""
    q["match_rides"] = with_(RIDES) + f"""
select 'PBE' as source, * from {_latest(f'eventTime <= {T}')} where {RULE_PREDICATE}
union all
select 'PE' as source, * from rides where eventTime > {T} and {RULE_PREDICATE}"""
    q["arrivals_window"] = with_(RIDES) + f"""
select cast(cell as varchar) as cell, eventTime, count(*) over (partition by cell order by eventTime
  range between interval 12 hour preceding and current row) as cnt
from (select {cell('endLon', 'endLat')} as cell, eventTime from rides where not isStart)"""
    q["arrivals_window_cell"] = with_(RIDES) + f"""
select cast(cell as varchar) as cell, eventTime, count(*) over (partition by cell order by eventTime
  range between interval 12 hour preceding and current row) as cnt
from (select {cell('endLon', 'endLat')} as cell, eventTime from rides where not isStart) where cell = {CELL}"""
    q["route_heatmap"] = _route_heatmap()
    q["travel_time"] = with_(RIDES, f"""c AS (select rideId, isStart, eventTime,
    {cell('endLon', 'endLat')} as cell,
    cast(trunc({angle('endLon', 'endLat', 'startLon', 'startLat')} / 45) as integer) as direction,
    {dist('startLon', 'startLat', 'endLon', 'endLat')} as distance,
    (epoch_ms(endTime) - epoch_ms(startTime)) / 60000.0::double as minutes
  from rides where {nyc('startLon', 'startLat')} and {nyc('endLon', 'endLat')})""",
                             """s AS (select *,
    sum(case when not isStart then distance * minutes end) over w as sxy,
    sum(case when not isStart then distance * distance end) over w as sxx,
    count(case when not isStart then 1 end) over w as n
  from c window w as (partition by cell, direction order by eventTime, (not isStart), rideId
    rows between unbounded preceding and 1 preceding))""") + """
select rideId, eventTime, cell, direction,
  case when n >= 2 and abs(sxx) >= 5e-323 then cast(trunc(sxy / sxx * distance) as integer) else -1 end
    as predictedMinutes
from s where isStart"""
    q["driving_sessions"] = with_(CARS, """p AS (select *, lag(eventTime) over (partition by carId order by eventTime, id) as prev
    from car_events)""", """f AS (select *, sum(case when prev is null or epoch_us(eventTime) - epoch_us(prev) > 43200000000
    then 1 else 0 end) over (partition by carId order by eventTime, id rows unbounded preceding) as sid from p)""") + """
select carId, count(*) as length, min(eventTime) as startTime, cast(trunc(max(speed)) as integer) as maxSpeed,
  round(stddev_pop(throttle), 6) as erraticness,
  case cast(trunc(stddev_pop(throttle) / 2.5) as integer) when 0 then 'calm' when 1 then 'busy'
    else 'crazy' end as erraticnessDesc
from f group by carId, sid"""
    q["driving_segments"] = _segments(between=False)
    q["driving_segments_between_stops"] = _segments(between=True)
    q["sort_car_events"] = with_(CARS) + \
        "select *, row_number() over (partition by carId order by eventTime, id) as rank from car_events"
    asof = with_(TRADES, CUSTOMERS) + """
select t.eventTime, t.customerId, t.tradeInfo, c.eventTime as customerTime, c.customerInfo
from trades t asof left join customers c on t.customerId = c.customerId and t.eventTime >= c.eventTime"""
    q["asof_join"] = asof
    q["latest_join"] = f"""with trades AS (
  select ts as eventTime, {ARRIVAL} as arrived, user_id as customerId, concat('trade-', cast(event_id as varchar)) as tradeInfo
  from events where event_type = 'purchase'),
customers AS (
  select ts as eventTime, {ARRIVAL} as arrived, user_id as customerId, concat('customer-', cast(event_id as varchar)) as customerInfo
  from events where event_type = 'signup'),
received AS (
  select t.*, c.eventTime as customerTime, c.customerInfo, row_number() over (
    partition by t.tradeInfo order by c.arrived desc, c.customerInfo desc) as k
  from trades t left join customers c on t.customerId = c.customerId and c.arrived <= t.arrived)
select eventTime, customerId, tradeInfo, customerTime, customerInfo from received where k = 1"""
    q["match_rules"] = with_(ITEMS, "r AS (select seq, shape, color from items where shape in ('view', 'purchase'))",
                             """n AS (select *, min(case when shape = 'purchase' then seq end) over (
      partition by color order by seq rows between 1 following and unbounded following) as nxt from r)""") + """
select 'Rule_0' as rule, color, seq as firstSeq, nxt as secondSeq from n where shape = 'view' and nxt is not null"""
    q["mail_count"] = with_(MAILS) + f"""
select substr(time, 1, 7) as month, {addr('sender')} as sender, count(*) as cnt from mails group by 1, 2"""
    q["tf_idf"] = _tf_idf(None, "documents", "doc_id", "text")
    q["tf_idf_mails"] = _tf_idf(MAILS, "mails", "messageId", "body")
    q["reply_graph"] = with_(MAILS, f"""m AS (select messageId, replyTo, {addr('sender')} as addr from mails
    where {addr('sender')} not in ({ex}))""") + """
select r.addr as replier, o.addr as original, count(*) as cnt
from m r join m o on r.replyTo = o.messageId group by 1, 2"""
    q["member_of_month"] = with_(MAILS, f"""c AS (select substr(time, 1, 7) as month, {addr('sender')} as sender,
    count(*) as cnt from mails where {addr('sender')} not in ({ex}) group by 1, 2)""") + """
select c.month, c.sender, c.cnt from c join (select month, max(cnt) as cnt from c group by 1) m using (month, cnt)"""
    q["weighted_pagerank"] = _pagerank(10, 0.85, 6)
    q["distinct_mails"] = with_(MAILS) + """
select * exclude (rn) from (select *, row_number() over (partition by messageId
  order by time, sender, subject, body, replyTo) as rn from mails) where rn = 1"""
    q["time_diff"] = with_(RIDES) + """
select rideId, startTime, endTime, epoch_ms(endTime) - epoch_ms(startTime) as diffMs,
  (epoch_ms(endTime) - epoch_ms(startTime)) / 60000.0::double as minutes
from rides where not isStart"""
    return q

"""Named ride and fare tables under one schema name.

Files become tables of a schema of the session catalog: an external table over the
file and a view with the SQL-facing columns (S20), so ``nyc.TaxiRides`` is
resolved by Spark's own parser in any query of the session, whatever its case,
and text in literals or patterns stays what it is. Streams cannot be catalog
tables; they are temporary views named ``{schema}_{name}``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..schemas import FARE_CSV, RIDE_CSV
from ..session import ensure_checkpoint_dir
from .rides import fare_table, read_fares, read_rides, ride_table

_NUMBERS = "coalesce(cast({0} AS {1}), cast(0 AS {1})) AS {0}"
_TIME = "to_timestamp({0}, 'yyyy-MM-dd HH:mm:ss')"

#: Columns of the ride and fare views over the CSV tables.
RIDES_SQL = f"""SELECT rideId, taxiId, driverId,
  CASE kind WHEN 'START' THEN true WHEN 'END' THEN false
    ELSE raise_error(concat('Invalid record kind: ', coalesce(kind, 'null'))) END AS isStart,
  {", ".join(_NUMBERS.format(c, "float") for c in ("startLon", "startLat", "endLon", "endLat"))},
  passengerCnt, {_TIME.format("time1")} AS eventTime
FROM {{source}}"""
FARES_SQL = f"""SELECT rideId, taxiId, driverId, paymentType,
  {", ".join(_NUMBERS.format(c, "double") for c in ("tip", "tolls", "totalFare"))}, {_TIME.format("startTime")} AS eventTime
FROM {{source}}"""


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


class TaxiCatalog:
    """The tables of one schema. A missing input file skips its table; asking for an
    unknown table raises KeyError."""

    def __init__(self, spark: SparkSession, schema: str = "nyc"):
        self.spark, self.schema = spark, schema
        self._tables: dict[str, str] = {}

    def _create_schema(self) -> None:
        if not self.spark.catalog.databaseExists(self.schema):
            where = f"{ensure_checkpoint_dir(self.spark)}/schema-{uuid.uuid4().hex}"
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(self.schema)} LOCATION '{where}'")

    def qualified(self, name: str) -> str:
        return f"{_quoted(self.schema)}.{_quoted(name)}"

    def add_view(self, name: str, query: str) -> None:
        """Table ``name`` of the schema as a view of SQL text over files or tables."""
        self._create_schema()
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.qualified(name)} AS {query}")
        self._tables[name] = self.qualified(name)

    def add_csv(self, name: str, path: str, columns: StructType, query: str) -> None:
        """Table ``name`` as ``query`` over an external CSV table (``{source}`` in it)."""
        self._create_schema()
        source = self.qualified(f"{name}_file")
        self.spark.sql(f"DROP TABLE IF EXISTS {source}")
        fields = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in columns)
        place = path.replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(f"CREATE TABLE {source} ({fields}) USING csv OPTIONS (mode 'FAILFAST', header 'false', path '{place}')")
        self.add_view(name, query.replace("{source}", source))

    def register(self, name: str, df: DataFrame) -> None:
        """A DataFrame (a stream, say) as the temporary view ``{schema}_{name}``."""
        df.createOrReplaceTempView(f"{self.schema}_{name}")
        self._tables[name] = _quoted(f"{self.schema}_{name}")

    def list_tables(self) -> list[str]:
        return sorted(self._tables)

    def view_name(self, name: str) -> str:
        if name not in self._tables:
            raise KeyError(f"table {self.schema}.{name} does not exist")
        return self._tables[name]

    def get_table(self, name: str) -> DataFrame:
        return self.spark.table(self.view_name(name))

    def sql(self, text: str) -> DataFrame:
        """Run a query that names the tables ``schema.Table``."""
        return self.spark.sql(text)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system of the path (local, HDFS,
    object stores), not the driver's local disk."""
    jvm = getattr(getattr(spark, "sparkContext", None), "_jvm", None)
    if jvm is None:      # a remote session: let the read decide
        return True
    p = jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return bool(found) and len(found) > 0


def register_catalog(spark: SparkSession, rides_path: str | None = None, fares_path: str | None = None,
                     schema: str = "nyc", max_delay_s: int | None = None,
                     streaming: bool = False) -> TaxiCatalog:
    """``TaxiRides`` and ``TaxiFares`` of ``schema`` over the CSV files that exist."""
    cat = TaxiCatalog(spark, schema)
    if rides_path and path_exists(spark, rides_path):
        if streaming:
            cat.register("TaxiRides", ride_table(read_rides(spark, rides_path, True), max_delay_s))
        else:
            cat.add_csv("TaxiRides", rides_path, RIDE_CSV, RIDES_SQL)
    if fares_path and path_exists(spark, fares_path):
        if streaming:
            cat.register("TaxiFares", fare_table(read_fares(spark, fares_path, True), max_delay_s))
        else:
            cat.add_csv("TaxiFares", fares_path, FARE_CSV, FARES_SQL)
    return cat

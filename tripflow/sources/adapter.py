"""Raw-trip rows derived from the ``orders`` table.

The trip feed itself is not shipped, so tests and benches derive rows in the raw trip schema
from ``orders`` with one SQL text that DuckDB runs unchanged.  It only shapes rows (both time
layouts, NULL end times, NULL coordinates, an unmapped pass type, round trips, a station grid)
and does none of the enrichment work; every operator downstream treats its input as any raw
trip data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# {orders} is substituted by a DataFrame reference in Spark and by the table name in DuckDB.
TRIPS_FROM_ORDERS_SQL = """
WITH o AS (
  SELECT o_orderkey AS k, o_custkey % 40 AS s, o_custkey AS c, o_orderpriority AS pr,
         CASE WHEN o_orderstatus = 'F' THEN o_custkey % 40
              ELSE (o_custkey * 7 + o_orderkey) % 40 END AS e,
         CAST(year(o_orderdate) AS STRING) AS y, CAST(month(o_orderdate) AS STRING) AS m,
         CAST(day(o_orderdate) AS STRING) AS d,
         CAST(o_orderkey % 24 AS STRING) AS hh, CAST(o_orderkey % 60 AS STRING) AS mi
  FROM {orders})
SELECT CAST(k AS INT) AS trip_id, CAST(1 + k % 120 AS INT) AS duration,
  CASE WHEN k % 2 = 0 THEN concat(m, '/', d, '/', y, ' ', hh, ':', lpad(mi, 2, '0'))
       ELSE concat(y, '-', lpad(m, 2, '0'), '-', lpad(d, 2, '0'), ' ', lpad(hh, 2, '0'), ':',
                   lpad(mi, 2, '0'), ':00') END AS start_time,
  CASE WHEN k % 97 = 0 THEN NULL ELSE concat(m, '/', d, '/', y, ' ', hh, ':59') END AS end_time,
  CAST(CASE WHEN s = 11 AND k % 5 = 0 THEN 211 ELSE s END AS INT) AS start_station,
  CASE WHEN k % 50 = 0 THEN NULL
       ELSE CAST(33.9 AS DOUBLE) + (s % 8) * CAST(0.05 AS DOUBLE) END AS start_lat,
  CAST(-118.6 AS DOUBLE) + (s % 5) * CAST(0.1 AS DOUBLE) AS start_lon,
  CAST(CASE WHEN e = 7 AND k % 3 = 0 THEN 107 ELSE e END AS INT) AS end_station,
  CAST(33.9 AS DOUBLE) + (e % 8) * CAST(0.05 AS DOUBLE) AS end_lat,
  CAST(-118.6 AS DOUBLE) + (e % 5) * CAST(0.1 AS DOUBLE) AS end_lon,
  CAST(c AS INT) AS bike_id,
  CASE k % 4 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 30 ELSE 365 END AS plan_duration,
  CASE WHEN s = e THEN 'Round Trip' ELSE 'One Way' END AS trip_route_category,
  CASE substr(pr, 1, 1) WHEN '1' THEN 'Walk-up' WHEN '2' THEN 'One Day Pass'
       WHEN '3' THEN 'Monthly Pass' WHEN '4' THEN 'Annual Pass' ELSE 'Flex Pass' END AS passholder_type,
  CASE k % 3 WHEN 0 THEN 'standard' WHEN 1 THEN 'electric' ELSE 'smart' END AS bike_type,
  y AS ptd
FROM o
"""


def raw_trips_from_orders(spark: SparkSession, orders: DataFrame) -> DataFrame:
    """Raw trip rows (15 raw columns + ``ptd`` year tag) shaped from ``orders``."""
    return spark.sql(TRIPS_FROM_ORDERS_SQL, orders=orders)


def load_raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips from ``{sf_dir}/orders.parquet`` (only the six order columns are read)."""
    from tripflow.plans.sizing import ensure_min_partitions
    orders = ensure_min_partitions(spark.read.parquet(f"{sf_dir}/orders.parquet"))
    return raw_trips_from_orders(spark, orders)

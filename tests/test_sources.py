import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.sources.jdbc import jdbc_options
from tripflow.sources.trips_csv import empty_enriched, read_period_csv, rejected_rows, trips_with_period, unmatched_files

HEADER = ("trip_id,duration,start_time,end_time,start_station,start_lat,start_lon,end_station,end_lat,end_lon,"
          "bike_id,plan_duration,trip_route_category,passholder_type,bike_type")
ROW = "1,5,7/1/2021 7:14,7/1/2021 7:19,3005,34.0,-118.2,3006,34.1,-118.3,6000,30,One Way,Monthly Pass,electric"


def write(path, text, bom=False):
    with open(path, "w", encoding="utf-8-sig" if bom else "utf-8") as f:
        f.write(text)


def test_period_csv_cases(spark, tmp_dir):
    write(f"{tmp_dir}/metro-trips-2021-q1.csv", HEADER + "\n" + ROW + "\n", bom=True)
    write(f"{tmp_dir}/metro-trips-2021-q2.csv", HEADER + "\n" + ROW.replace("1,5,", "2,x,", 1) + "\n"
          + "3,7,7/2/2021 8:00\n")
    write(f"{tmp_dir}/metro-trips-2020-q4.csv", "")
    write(f"{tmp_dir}/metro-trips-latest.csv", HEADER + "\n" + ROW.replace("1,5,", "9,5,", 1) + "\n")
    write(f"{tmp_dir}/stations.csv", "id,name\n1,a\n")
    df = read_period_csv(spark, tmp_dir)
    rows = {r["trip_id"]: r for r in df.collect()}
    assert set(rows) == {1, 2, 3, 9}
    assert rows[1]["period"] == "2021-q1" and rows[1]["ptd"] == "2021" and rows[1]["duration"] == 5
    assert rows[1]["_corrupt_record"] is None
    assert rows[2]["duration"] is None and rows[2]["_corrupt_record"] is not None  # bad int
    assert rows[3]["end_time"] is None and rows[3]["start_station"] is None  # short row
    assert rows[9]["period"] is None
    assert trips_with_period(df).count() == 3
    assert [r[0] for r in unmatched_files(df).collect()] == ["metro-trips-latest.csv"]


def test_rejected_rows(spark, tmp_dir):
    write(f"{tmp_dir}/metro-trips-2021-q1.csv", HEADER + "\n" + ROW + "\n" + ROW.replace("1,5,", "2,x,", 1) + "\n"
          + ROW.replace("34.0", "").replace("1,5,", "3,5,", 1) + "\n" + ROW.replace("7/1/2021 7:14", "soon").replace("1,5,", "4,5,", 1) + "\n")
    write(f"{tmp_dir}/metro-trips-latest.csv", HEADER + "\n" + ROW + "\n")
    got = {(r["source_file"], r["reason"]): r["rows"] for r in rejected_rows(read_period_csv(spark, tmp_dir)).collect()}
    q1 = "metro-trips-2021-q1.csv"
    assert got == {(q1, "bad row"): 1, (q1, "no coordinates"): 1, (q1, "no start time"): 1, ("metro-trips-latest.csv", "no period"): 1}


def test_plain_csv_rows(spark, tmp_dir):
    from tripflow.sources.sinks import append_csv
    from tripflow.sources.trips_csv import read_csv_rows
    df = spark.createDataFrame([(1, "a,b"), (2, "c")], "id int, name string")
    append_csv(df, f"{tmp_dir}/rows")
    append_csv(df.limit(1), f"{tmp_dir}/rows")
    assert sorted(tuple(r) for r in read_csv_rows(spark, f"{tmp_dir}/rows").collect()) == [("1", "a,b"), ("1", "a,b"), ("2", "c")]


def test_empty_enriched(spark):
    e = empty_enriched(spark)
    assert e.count() == 0 and "ptd" in e.columns and len(e.columns) == 25


def test_jdbc_options():
    o = jdbc_options("db.host", "bikes", "trips", "u", "p", partition_column="trip_id", lower_bound=0,
                     upper_bound=1000, num_partitions=8)
    assert o["url"] == "jdbc:mysql://db.host:3306/bikes" and o["numPartitions"] == "8"
    try:
        jdbc_options("h", "d", "t", "u", "p", partition_column="x")
        raise AssertionError("expected ValueError")
    except ValueError:
        pass


def test_sinks(spark, tmp_dir):
    from tripflow.sources.sinks import export_csv, export_json, write_partitioned, write_period_csv
    df = spark.range(10).select(F.col("id").cast("int").alias("v"), (F.col("id") % 2).cast("string").alias("ptd"))
    write_partitioned(df, f"{tmp_dir}/t", "ptd")
    write_partitioned(df.where("ptd = '1'").withColumn("v", F.col("v") + 100), f"{tmp_dir}/t", "ptd")
    back = spark.read.parquet(f"{tmp_dir}/t")
    assert sorted(r["v"] for r in back.where("ptd = '0'").collect()) == [0, 2, 4, 6, 8]
    assert sorted(r["v"] for r in back.where("ptd = '1'").collect()) == [101, 103, 105, 107, 109]
    export_csv(df, f"{tmp_dir}/csv", max_rows=3, sort=["v"])
    files = [f for f in os.listdir(f"{tmp_dir}/csv") if f.endswith(".csv")]
    assert len(files) >= 4
    back = spark.read.option("header", True).csv(f"{tmp_dir}/csv")
    assert back.count() == 10
    ts = spark.sql("SELECT TIMESTAMP_NTZ'2021-07-01 07:14:05' AS t, DATE'2021-07-01' AS d, 'é' AS s")
    export_json(ts, f"{tmp_dir}/json")
    txt = "".join(open(os.path.join(f"{tmp_dir}/json", f), encoding="utf-8").read()
                  for f in os.listdir(f"{tmp_dir}/json") if f.endswith(".json"))
    assert '"2021-07-01 07:14:05"' in txt and '"2021-07-01"' in txt and "é" in txt
    write_period_csv(df.withColumn("period", F.concat(F.lit("2021-q"), F.col("ptd"))).drop("ptd"), f"{tmp_dir}/periods")
    back = read_period_csv(spark, f"{tmp_dir}/periods", schema=T.StructType([T.StructField("v", T.IntegerType())]))
    assert sorted((r["v"], r["period"], r["ptd"]) for r in back.collect()) == [(i, f"2021-q{i % 2}", "2021") for i in range(10)]

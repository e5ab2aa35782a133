import os
import shutil

from pyspark.sql import functions as F

from tripflow.plans import catalog
from tripflow.plans.batch_job import build_trip_table, run_trip_job
from tripflow.queries import QUERIES, TRIP_REGIONS
from tripflow.sources.adapter import load_raw_trips
from tripflow.sources.regions import regions_from_rows
from tripflow.sources.sinks import write_period_csv
from tripflow.streaming.ingest import enriched_table_stream, hourly_usage_stream, rejects_path, start_trip_ingest

SF = "/root/testdata/sf0.001"


def trip_csvs(spark, path):
    raw = load_raw_trips(spark, SF).drop("ptd")
    st = F.to_timestamp(F.col("start_time"), "M/d/yyyy H:mm")
    raw = raw.withColumn("period", F.concat(F.lit("1998-q"), (F.col("trip_id") % 4 + 1).cast("string")))
    write_period_csv(raw, path)
    return raw


def test_run_trip_job(spark, tmp_dir):
    raw = trip_csvs(spark, f"{tmp_dir}/src")
    out = run_trip_job(spark, f"{tmp_dir}/src", f"{tmp_dir}/dw", regions_from_rows(spark, TRIP_REGIONS),
                       export_dir=f"{tmp_dir}/app", table="tf_job_db.trip_details")
    kept = raw.dropna(subset=["start_lat", "start_lon", "end_lat", "end_lon"]).count()
    assert out["trip_details"].count() == kept
    assert [r["ptd"] for r in out["trip_details"].select("ptd").distinct().collect()] == ["1998"]
    assert out["app_trip_cnt_by_hour"].count() > 0
    assert {r["column"] for r in out["statistics"].collect()} >= {"duration", "distance"}
    assert any(f.endswith(".csv") for f in os.listdir(f"{tmp_dir}/app/app_trip_cnt_by_hour"))
    assert spark.read.option("header", True).csv(f"{tmp_dir}/app/trip_details").count() == kept
    assert spark.table("tf_job_db.trip_details").count() == kept
    assert {(r["reason"], r["rows"]) for r in out["rejected"].groupBy("reason").agg(F.sum("rows").alias("rows")).collect()} == {("no coordinates", raw.count() - kept)}
    catalog.drop_database(spark, "tf_job_db", cascade=True)


def test_a_later_quarter_keeps_the_earlier_ones(spark, tmp_dir):
    raw = trip_csvs(spark, f"{tmp_dir}/all")
    have = raw.dropna(subset=["start_lat", "start_lon", "end_lat", "end_lon"])
    for q in (1, 2, 3, 4, 2):
        write_period_csv(raw.where(F.col("period") == f"1998-q{q}"), f"{tmp_dir}/src{q}")
        table = build_trip_table(spark, f"{tmp_dir}/src{q}", f"{tmp_dir}/dw")
    assert table.count() == have.count()
    # A quarter that changed replaces itself alone.
    write_period_csv(raw.where((F.col("period") == "1998-q2") & (F.col("trip_id") % 8 == 1)), f"{tmp_dir}/new")
    table = build_trip_table(spark, f"{tmp_dir}/new", f"{tmp_dir}/dw")
    assert table.count() == have.where("period <> '1998-q2' OR trip_id % 8 = 1").count()


def test_load_without_files_gives_an_empty_table(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/none")
    with open(f"{tmp_dir}/none/metro-trips-2021-q1.csv", "w") as f:
        f.write("")
    out = run_trip_job(spark, f"{tmp_dir}/none", f"{tmp_dir}/dw")
    assert out["app_trip_cnt_by_hour"].count() == 0 and out["rejected"].count() == 0


def test_catalog_helpers(spark):
    catalog.create_database(spark, "tf_test_db")
    assert "tf_test_db" in catalog.list_databases(spark)
    from tripflow.sources.sinks import write_table
    df = spark.range(6).select(F.col("id").alias("v"), (F.col("id") % 3 + 2019).cast("string").alias("ptd"))
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    write_table(df, "tf_test_db.trips", "ptd")
    write_table(df.where("ptd = '2019'").withColumn("v", F.col("v") * 10), "tf_test_db.trips", "ptd")
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode
    assert sorted(r["v"] for r in spark.table("tf_test_db.trips").where("ptd = '2019'").collect()) == [0, 30]
    assert "trips" in catalog.list_tables(spark, "tf_test_db")
    parts = sorted(r[0] for r in catalog.list_partitions(spark, "tf_test_db.trips").collect())
    assert parts == ["ptd=2019", "ptd=2020", "ptd=2021"]
    assert catalog.drop_partitions_where(spark, "tf_test_db.trips", "ptd", "<", "2021") == ["2019", "2020"] or \
        sorted(catalog.drop_partitions_where(spark, "tf_test_db.trips", "ptd", "<", "2021")) == []
    assert sorted(r[0] for r in catalog.list_partitions(spark, "tf_test_db.trips").collect()) == ["ptd=2021"]
    catalog.drop_partition(spark, "tf_test_db.trips", {"ptd": "2021"})
    assert spark.table("tf_test_db.trips").count() == 0
    assert catalog.table_info(spark, "tf_test_db.trips").count() > 0
    catalog.truncate_table(spark, "tf_test_db.trips")
    catalog.drop_table(spark, "tf_test_db.trips")
    catalog.drop_database(spark, "tf_test_db", cascade=True)
    assert "tf_test_db" not in catalog.list_databases(spark)
    assert catalog.quote("a.b`c") == "`a`.`b``c`"


def test_recover_sql_schema_and_order(spark, tmp_dir):
    df = spark.range(4).select(F.col("id").alias("v"), (F.col("id") % 2 + 2019).cast("string").alias("ptd"))
    catalog.create_database(spark, "tf_rec_db", use=False)
    spark.sql(f"CREATE TABLE tf_rec_db.t (v BIGINT, ptd STRING) USING parquet PARTITIONED BY (ptd) LOCATION '{tmp_dir}/t'")
    df.write.mode("append").partitionBy("ptd").parquet(f"{tmp_dir}/t")
    assert spark.table("tf_rec_db.t").count() == 0  # the catalog does not know the folders yet
    catalog.recover_partitions(spark, "tf_rec_db.t")
    assert spark.table("tf_rec_db.t").count() == 4
    assert sorted(r["ptd"] for r in catalog.partition_values(spark, "tf_rec_db.t").collect()) == ["2019", "2020"]
    catalog.drop_database(spark, "tf_rec_db", cascade=True)
    top = catalog.run_sql(spark, "SELECT ptd, sum(v) AS s FROM {trips} GROUP BY ptd", trips=df)
    assert {(r["ptd"], r["s"]) for r in top.collect()} == {("2019", 2), ("2020", 4)}
    assert "|-- v: long" in catalog.schema_text(df) and "|-- ptd: string" in catalog.schema_text(df)
    hours = [r["start_hour"] for r in QUERIES["hour_rollup"](spark, SF).collect()]
    assert len(hours) > 1 and hours == sorted(hours)


def test_streaming_ingest_and_hourly(spark, tmp_dir):
    raw = trip_csvs(spark, f"{tmp_dir}/src")
    write_period_csv(raw.where("trip_id % 100 = 3").withColumn("period", F.lit("latest")), f"{tmp_dir}/late")
    shutil.copytree(f"{tmp_dir}/late/file=metro-trips-latest.csv", f"{tmp_dir}/src/file=metro-trips-latest.csv")
    q = start_trip_ingest(spark, f"{tmp_dir}/src", f"{tmp_dir}/dw", f"{tmp_dir}/ck",
                          regions_from_rows(spark, TRIP_REGIONS), max_files_per_trigger=2)
    q.awaitTermination(300)
    kept = raw.dropna(subset=["start_lat", "start_lon", "end_lat", "end_lon"]).count()
    table = spark.read.parquet(f"{tmp_dir}/dw")
    assert table.count() == kept
    why = spark.read.parquet(rejects_path(f"{tmp_dir}/dw")).groupBy("reason").agg(F.sum("rows").alias("n")).collect()
    late = raw.where("trip_id % 100 = 3")
    none = raw.count() - kept + late.count() - late.dropna(subset=["start_lat", "start_lon", "end_lat", "end_lon"]).count()
    assert {r["reason"]: r["n"] for r in why} == {"no coordinates": none, "no period": late.count()}
    assert table.select("batch").distinct().count() >= 2
    # The same checkpoint adds nothing; a new one is a run of its own beside the first.
    again = start_trip_ingest(spark, f"{tmp_dir}/src", f"{tmp_dir}/dw", f"{tmp_dir}/ck", regions_from_rows(spark, TRIP_REGIONS))
    again.awaitTermination(300)
    assert spark.read.parquet(f"{tmp_dir}/dw").count() == kept
    fresh = start_trip_ingest(spark, f"{tmp_dir}/src", f"{tmp_dir}/dw2", f"{tmp_dir}/ck2")
    fresh.awaitTermination(300)
    fresh = start_trip_ingest(spark, f"{tmp_dir}/src", f"{tmp_dir}/dw2", f"{tmp_dir}/ck3")
    fresh.awaitTermination(300)
    both = spark.read.parquet(f"{tmp_dir}/dw2")
    assert both.select("run").distinct().count() == 2 and both.count() == 2 * kept
    hs = hourly_usage_stream(enriched_table_stream(spark, f"{tmp_dir}/dw"), watermark="1 hour")
    sq = hs.writeStream.format("memory").queryName("tf_hourly").outputMode("append").trigger(availableNow=True).start()
    sq.awaitTermination(300)
    n = spark.sql("SELECT sum(used_count) FROM tf_hourly").first()[0]
    la = table.where("city_name = 'LA'").count()
    assert n is not None and 0 < n <= la
    # Every emitted window equals the batch rollup of the same hour.
    from tripflow.operators.rollup import hourly_usage
    batch = {r["start_hour"]: (r["used_count"], r["total_duration"]) for r in hourly_usage(table).collect()}
    for r in spark.sql("SELECT start_hour, used_count, total_duration FROM tf_hourly").collect():
        assert batch[r["start_hour"]] == (r["used_count"], r["total_duration"])


def counted(df, seen):
    """``df``, adding the rows that are read from it to an accumulator."""
    def add(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    return df.mapInArrow(add, df.schema)


def test_partition_reload_makes_its_rows_once(spark, monkeypatch):
    """Three loads and their checks read stored rows; the feed is made and its times are parsed once."""
    from tripflow import queries
    seen, sound = spark.sparkContext.accumulator(0), queries.load_raw_trips
    monkeypatch.setattr(queries, "load_raw_trips", lambda *a: counted(sound(*a), seen))
    table = QUERIES["partition_reload"](spark, SF)
    raw = sound(spark, SF)
    assert seen.value == raw.count()
    kept = raw.dropna(subset=["start_lat", "start_lon", "end_lat", "end_lon"])
    assert table.count() == kept.count() == table.select("trip_id").distinct().count()


def test_a_load_parses_its_files_once(spark, tmp_dir, monkeypatch):
    from tripflow.plans import batch_job
    raw = trip_csvs(spark, f"{tmp_dir}/src")
    seen, sound = spark.sparkContext.accumulator(0), batch_job.read_period_csv
    monkeypatch.setattr(batch_job, "read_period_csv", lambda *a: counted(sound(*a), seen))
    table = build_trip_table(spark, f"{tmp_dir}/src", f"{tmp_dir}/dw", regions_from_rows(spark, TRIP_REGIONS))
    assert seen.value == raw.count()
    assert table.count() == raw.dropna(subset=["start_lat", "start_lon", "end_lat", "end_lon"]).count()

"""Versioned loads: what readers see while a load runs, fails, or races another."""
import os

import pytest
from pyspark.sql import functions as F

from tripflow.plans import catalog, versions
from tripflow.plans import batch_job
from tripflow.queries import _with_period

SF = "/root/testdata/sf0.001"


def frame(spark, rows):
    return spark.createDataFrame(rows, "v int, ptd string, period string")


def rows(df):
    return sorted((r["v"], r["ptd"], r["period"]) for r in df.collect())


def loads(path):
    return {d for d in os.listdir(path) if d.startswith("load=")}


def test_partitions_are_replaced_and_versions_stay_readable(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    schema = frame(spark, []).schema
    assert versions.read_version(spark, path, schema).count() == 0 and versions.versions(spark, path) == []
    a = [(1, "2020", "2020-q1"), (2, "2020", "2020-q2"), (3, None, "odd/na=me %41+")]
    assert versions.commit_load(frame(spark, a), path) == 1
    first = versions.read_version(spark, path, schema)
    assert versions.commit_load(frame(spark, [(9, "2020", "2020-q2")]), path) == 2
    assert sorted(r["v"] for r in versions.read_version(spark, path, schema).collect()) == [1, 3, 9]
    assert sorted(r["v"] for r in first.collect()) == [1, 2, 3]  # what was opened before does not change
    assert versions.read_version(spark, path, schema).where("v = 3").first()["period"] == "odd/na=me %41+"
    assert versions.commit_load(frame(spark, [(7, "2021", "2021-q1")]), path, replace=True) == 3
    assert rows(versions.read_version(spark, path, schema)) == [(7, "2021", "2021-q1")]
    assert versions.commit_load(frame(spark, []), path) == 4  # nothing to load: the same rows
    assert rows(versions.read_version(spark, path, schema)) == [(7, "2021", "2021-q1")]
    assert versions.expire(spark, path, keep=1) == []  # young folders stay
    assert len(versions.expire(spark, path, keep=1, grace_hours=0)) == 3 and versions.versions(spark, path) == [4]
    assert rows(versions.read_version(spark, path, schema)) == [(7, "2021", "2021-q1")] and len(loads(path)) == 1


def test_wrong_counts_and_failures_leave_the_old_version(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    df = frame(spark, [(1, "2020", "2020-q1"), (2, "2020", ""), (3, "2021", None)])
    want = df.groupBy("ptd", "period").agg(F.count(F.lit(1)).alias("rows"))
    assert versions.commit_load(df, path, expected=want) == 1
    before = loads(path)
    with pytest.raises(versions.LoadMismatch):
        versions.commit_load(df.unionByName(df.where("v = 3")), path, expected=want, replace=True)
    with pytest.raises(versions.LoadMismatch):  # a period that did not arrive
        versions.commit_load(df.where("v > 1"), path, expected=want, replace=True)
    broken = frame(spark, [(i, "2022", "2022-q1") for i in range(1000)]).repartition(8)
    with pytest.raises(Exception, match="half way"):
        versions.commit_load(broken.withColumn("v", F.when(F.col("v") == 900, F.raise_error(F.lit("half way"))).otherwise(F.col("v")).cast("int")), path)
    assert versions.versions(spark, path) == [1] and loads(path) == before
    assert versions.read_version(spark, path, df.schema).count() == 3


def test_two_loads_at_once_keep_both(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/t"
    versions.commit_load(frame(spark, [(1, "2020", "2020-q1")]), path)
    look, other = versions.partitions_at, frame(spark, [(2, "2020", "2020-q2")])
    raced = []

    def late(*args):
        seen = look(*args)
        if not raced:  # another load comes between this one's look and its claim
            raced.append(1)
            versions.commit_load(other, path)
        return seen

    monkeypatch.setattr(versions, "partitions_at", late)
    assert versions.commit_load(frame(spark, [(3, "2020", "2020-q3")]), path) == 3
    monkeypatch.undo()
    assert sorted(r["v"] for r in versions.read_version(spark, path, other.schema).collect()) == [1, 2, 3]


def test_a_failed_rebuild_keeps_the_table_by_path_and_by_name(spark, tmp_dir, monkeypatch):
    path, name = f"{tmp_dir}/dw", "tf_version_db.trip_details"
    raw = _with_period(spark, SF)
    batch_job.load_trips(raw, None, path, name, rebuild=True)
    n = batch_job.load_trip_table(spark, path).count()
    assert n == spark.table(name).count() > 0
    sound = batch_job.enrich_trips

    def fails(trips, regions, keep=()):
        out = sound(trips, regions, keep=keep)
        return out.withColumn("duration", F.when(F.col("trip_id") % 700 == 3, F.raise_error(F.lit("half way"))).otherwise(F.col("duration")).cast("int"))

    def loses(trips, regions, keep=()):
        return sound(trips, regions, keep=keep).where("trip_id % 700 <> 3")

    for wrong in (fails, loses):
        monkeypatch.setattr(batch_job, "enrich_trips", wrong)
        with pytest.raises(Exception):
            batch_job.load_trips(raw, None, path, name, rebuild=True)
        assert batch_job.load_trip_table(spark, path).count() == n == spark.table(name).count()
    monkeypatch.undo()
    # A name that was opened before a load goes on reading its version; the name shows the new one.
    before = spark.table(name)
    batch_job.load_trips(raw.where("trip_id % 2 = 0"), None, path, name, rebuild=True)
    half = batch_job.load_trip_table(spark, path)
    assert 0 < half.count() < n and spark.table(name).count() == half.count() and before.count() == n
    assert half.where("ptd = '1998'").count() == spark.table(name).where("ptd = '1998'").count()
    years = {r["ptd"] for r in catalog.partition_values(spark, f"{name}__v2").collect()}
    assert years == {r["ptd"] for r in half.select("ptd").distinct().collect()}
    gone = catalog.drop_partitions_where(spark, f"{name}__v2", "ptd", "<", "1998")
    assert gone == sorted(y for y in years if y < "1998")  # each year once, though it has many periods
    batch_job.load_trips(raw, None, path, name, rebuild=True)
    assert set(catalog.list_tables(spark, "tf_version_db")) == {"trip_details", "trip_details__v2", "trip_details__v3"}
    assert spark.table(name).count() == n
    catalog.drop_database(spark, "tf_version_db", cascade=True)
    assert batch_job.load_trip_table(spark, path).count() == n  # names own no files


def test_publish_needs_a_free_name(spark, tmp_dir):
    df = frame(spark, [(1, "2020", "2020-q1")])
    versions.commit_load(df, f"{tmp_dir}/t")
    catalog.create_database(spark, "tf_taken_db", use=False)
    df.write.saveAsTable("tf_taken_db.t")
    with pytest.raises(ValueError, match="free name"):
        versions.publish(spark, f"{tmp_dir}/t", "tf_taken_db.t", df.schema)
    catalog.drop_database(spark, "tf_taken_db", cascade=True)

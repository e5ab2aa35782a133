from pyspark.sql import functions as F

from tripflow.plans.catalog import plan_text
from tripflow.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_rollup_plan_is_jvm_only(spark):
    p = plan_text(QUERIES["hour_rollup"](spark, SF))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    assert "HashAggregate" in p


def test_enrich_plan_has_no_row_python(spark):
    p = plan_text(QUERIES["trip_enrich"](spark, SF))
    assert "BatchEvalPython" not in p
    # The one kernel, the geodesic, runs over distinct coordinate pairs: above their aggregation.
    assert p.count("ArrowEvalPython") <= 2 and "HashAggregate" in p


def test_scan_prunes_columns(spark):
    p = plan_text(QUERIES["hour_rollup"](spark, SF))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_orderdate:timestamp_ntz,o_orderpriority:string>" in p
    assert "o_totalprice" not in p


def test_filter_pushdown(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet").where(F.col("event_type") == "click").select("value")
    p = plan_text(ev)
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,click)]" in p


def test_partition_pruning(spark, tmp_dir):
    from tripflow.plans.batch_job import load_trip_table
    from tripflow.sources.sinks import write_partitioned
    t = QUERIES["trip_enrich"](spark, SF)
    write_partitioned(t.withColumn("period", F.concat("ptd", F.lit("-q1"))), f"{tmp_dir}/dw")
    p = plan_text(load_trip_table(spark, f"{tmp_dir}/dw").where(F.col("ptd") == "1997").select("duration"))
    assert "PartitionFilters: [isnotnull(ptd" in p and "(ptd" in p


def test_dbscan_has_no_cartesian_product(spark):
    from tripflow.operators import cluster
    pts = cluster.with_point_ids(spark.createDataFrame([(0.0, 0.0, 1), (1.0, 1.0, 2)], "x double, y double, w long"),
                                 ["x", "y"])
    near = cluster._Neighbours(pts, 0.5)
    for p in (plan_text(near.start), plan_text(near.degrees())):
        assert "CartesianProduct" not in p and "NestedLoopJoin" not in p


def test_region_tag_has_no_cartesian_product(spark):
    p = plan_text(QUERIES["region_tag"](spark, SF))
    assert "CartesianProduct" not in p and "NestedLoopJoin" not in p


def test_distance_modes_agree(spark):
    from tripflow.operators.enrich import enrich_trips
    from tripflow.sources.adapter import load_raw_trips
    raw = load_raw_trips(spark, SF)
    a = {r["trip_id"]: r["distance"] for r in enrich_trips(raw, distance_mode="rows").select("trip_id", "distance").collect()}
    b = {r["trip_id"]: r["distance"] for r in enrich_trips(raw, distance_mode="pairs").select("trip_id", "distance").collect()}
    assert a == b and len(a) > 0


def _largest_method(df):
    """Bytes of the largest method that is generated for a plan (as it is before execution)."""
    import contextlib
    import io
    import re
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("codegen")
    return max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text.getvalue()))


def test_enrichment_is_compiled(spark, tmp_dir):
    """The JVM interprets methods of more than 8000 bytes: each stage between the joins' shuffles stays below."""
    from tripflow.operators.enrich import enrich_trips
    from tripflow.queries import TRIP_REGIONS, _with_period
    from tripflow.sources.regions import regions_from_rows
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        _with_period(spark, "/root/testdata/sf0.001").write.parquet(f"{tmp_dir}/trips")
        raw = spark.read.parquet(f"{tmp_dir}/trips")
        assert _largest_method(enrich_trips(raw, None, keep=("period",))) < 8000
        assert _largest_method(enrich_trips(raw, regions_from_rows(spark, TRIP_REGIONS), keep=("period",))) < 8000
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)

"""The jobs from raw catalog tables to recommendations."""

from __future__ import annotations

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from skyledger.plans import jobs
from skyledger.operators.itineraries import REPORT_HEADINGS
from skyledger.sources.scratch import clear_scratch, materialize, scratch_root, scratch_scope
from skyledger.sources.tables import replace_path, replace_table
from tests.data import raw, airports


def test_raw_tables_to_recommendations(spark, tmp_path):
    rows = [
        {
            "leg_id": f"L{i % 20}",
            "search_date": f"2022-04-{i % 28 + 1:02d}",
            "flight_date": f"2022-05-{i % 3 + 1:02d}",
            "total_fare": str(100 + i % 37),
        }
        for i in range(120)
    ]
    replace_table(raw(spark, *rows), "raw_itineraries")
    replace_table(airports(spark, "SFO", "DEN", '"PHL"'), "raw_airports")

    fact = jobs.build_warehouse(spark, "raw_itineraries", "raw_airports")
    assert fact.count() == 240
    keys = [c for c in fact.columns if c.endswith("_fk")]
    assert fact.where(" or ".join(f"{k} = 0" for k in keys)).isEmpty()
    assert spark.table("dim_date").count() == 28 + 3

    assert jobs.build_segment_fact(spark, "raw_itineraries", "fact_segments").count() == 240
    wide = jobs.build_wide_flights(spark, "raw_itineraries", "wide_flights")
    assert wide.count() == 240
    requests = spark.createDataFrame(
        [("SFO", "PHL", dt.date(2022, 5, 1))],
        "origin string, destination string, flight_date date",
    )
    jobs.find_connections(spark, "wide_flights", requests, str(tmp_path / "trips"))
    lines = [x for f in (tmp_path / "trips").glob("part-*") for x in f.read_text().splitlines()]
    first = wide.where("flight_date = '2022-05-01' and segment_index = 1")
    per_search = [r["count"] for r in first.groupBy("search_date").count().collect()]
    assert len(lines) == sum(n**2 for n in per_search)
    assert {json.loads(x)["route_type"] for x in lines} == {"1-transfer"}

    root = str(tmp_path / "wide")
    schema = replace_path(wide, root, jobs.SEGMENT_PARTITIONS).schema
    report = jobs.report_itineraries(
        spark, root, schema, "2022-04-01", dt.date(2022, 5, 1), "sfo", "PHL"
    )
    assert report.columns == list(REPORT_HEADINGS.values()) and report.count() > 0
    filters = report._jdf.queryExecution().executedPlan().toString()
    filters = filters.split("PartitionFilters: [")[1].split("]")[0]
    assert "search_date" in filters and "(flig" in filters
    none = jobs.report_itineraries(
        spark, str(tmp_path / "gone"), schema, "2022-04-01", "2022-05-01", "SFO", "PHL"
    )
    assert none.count() == 0

    training = jobs.build_training_table(spark, "fact_flight_ticket", "dim_date", "training")
    assert training.where("is_best_time_to_buy = 1").count() > 0
    jobs.build_price_rules(spark, "fact_flight_ticket", "rules")
    trained = jobs.train(
        spark, "training", str(tmp_path / "model"), fraction=1.0, maxIter=2, maxDepth=2
    )
    assert trained.rmse > 0
    scored = jobs.score(spark, "rules", str(tmp_path / "model"), "predictions", "2022-06-01")
    assert scored.count() == 2 * 36
    assert {r.recommendation for r in scored.collect()} <= {0, 1}


def test_path_job_touches_only_its_partitions(spark, dynamic_overwrite):
    source = spark.createDataFrame(
        [("A -> A -> B", "d1"), (None, "d1")], "full_path string, day string"
    )
    target = spark.createDataFrame(
        [("old", "d1"), ("kept", "d2")], "full_path string, day string"
    )
    replace_table(source, "details", ["day"])
    replace_table(target, "details_cleaned", ["day"])
    jobs.clean_itinerary_paths(spark, "details", "details_cleaned", ("day",))
    rows = spark.table("details_cleaned").orderBy("day", F.col("full_path").asc_nulls_first())
    assert [tuple(r) for r in rows.collect()] == [
        (None, "d1"), ("A -> B", "d1"), ("kept", "d2")
    ]


def test_lookup_files_to_tables(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "type,name,latitude_deg,longitude_deg,iso_country,iso_region,municipality\n"
        'small,"two\nlines, ""quoted""",1.5,bad,NA,R,\n,,,,,,\n'
    )
    (tmp_path / "c.csv").write_text("code,name\nNA,Namibia\n,\n")
    jobs.import_lookups(
        spark, str(tmp_path / "a.csv"), str(tmp_path / "c.csv"), "airports", "countries"
    )
    assert [tuple(r) for r in spark.table("airports").collect()] == [
        ("small", 'two\nlines, "quoted"', 1.5, None, "NA", "R", "")
    ]
    assert [tuple(r) for r in spark.table("countries").collect()] == [("NA", "Namibia")]


def test_scratch_can_be_cleared(spark, monkeypatch):
    from skyledger.sources import scratch

    monkeypatch.setattr(scratch, "_roots", {})
    root = scratch_root(spark)
    path = root.removeprefix("file:")
    materialize(spark.range(3), "three")
    assert os.path.isdir(path)
    clear_scratch(spark)
    assert not os.path.isdir(path) and scratch_root(spark) != root


def test_a_scope_leaves_nothing_behind(spark):
    outside = materialize(spark.range(3), "outside")
    before = set(os.listdir(scratch_root(spark)))
    with scratch_scope(spark):
        inner = materialize(spark.range(5), "inner")
        with scratch_scope(spark):
            materialize(spark.range(7), "innermost")
        assert inner.count() == 5
        assert len(os.listdir(scratch_root(spark))) == len(before) + 1
    try:
        with scratch_scope(spark):
            materialize(spark.range(5), "failed")
            raise RuntimeError("stop")
    except RuntimeError:
        pass
    assert set(os.listdir(scratch_root(spark))) == before and outside.count() == 3


def test_jobs_leave_no_scratch(spark):
    replace_table(raw(spark, {}, {"leg_id": "L2"}), "raw_for_scratch")
    replace_table(airports(spark, "SFO", "DEN", "PHL"), "airports_for_scratch")
    scratch = materialize(spark.range(1), "here")
    before = set(os.listdir(scratch_root(spark)))
    names = jobs.WarehouseTables(*[f"scratch_{i}" for i in range(6)])
    fact = jobs.build_warehouse(spark, "raw_for_scratch", "airports_for_scratch", names)
    assert fact.count() == 4 and scratch.count() == 1
    assert set(os.listdir(scratch_root(spark))) == before

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame
from pyspark.sql.readwriter import DataFrameWriter

from skyledger.sources import lookup_files as lf
from skyledger.sources import scratch, tables
from tests.data import same_rows

AIRPORTS = '''id,type,name,latitude_deg,longitude_deg,iso_country,iso_region,municipality
1,small,"Field, North",1.5,-2.25,NA,NA-1,Rundu
2,small,"Say ""hi""",bad,,US,US-CA,
,,,,,,,
'''


def write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_airports(spark, tmp_path):
    path = write(tmp_path / "airports.csv", AIRPORTS)
    df = lf.airports_table(lf.load_lookup_csv(spark, path, lf.AIRPORT_COLUMNS))
    assert dict(df.dtypes)["latitude_deg"] == "double"
    rows = df.orderBy("name").collect()
    assert [tuple(r) for r in rows] == [
        ("small", "Field, North", 1.5, -2.25, "NA", "NA-1", "Rundu"),
        ("small", 'Say "hi"', None, None, "US", "US-CA", ""),
    ]


def test_lookup_reads_only_the_columns_asked_for(spark, tmp_path):
    path = write(tmp_path / "airports.csv", AIRPORTS)
    df = lf.load_lookup_csv(spark, path, ["name", "iso_country"])
    assert df.columns == ["name", "iso_country"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "latitude_deg" not in plan.split("ReadSchema")[1]


def test_countries(spark, tmp_path):
    path = write(tmp_path / "countries.csv", "iso,label\nNA,Namibia\n,\nDE,Germany\n")
    df = lf.countries_table(lf.load_lookup_csv(spark, path))
    assert sorted(tuple(r) for r in df.collect()) == [("DE", "Germany"), ("NA", "Namibia")]
    with pytest.raises(ValueError):
        lf.countries_table(df.withColumn("third", F.lit(1)))


def test_encodings(spark, tmp_path):
    folder = tmp_path / "countries"
    folder.mkdir()
    utf8 = write(folder / "a.csv", "code,name\nCN,中国\n")
    gbk = write(folder / "b.csv", "code,name\nJP,日本\n", "gbk")
    assert [p.rsplit("/", 1)[1] for p in lf.files_not_utf8(spark, [utf8, gbk])] == ["b.csv"]
    both = lf.load_lookup_csv(spark, [utf8, gbk], fallback_encoding="GBK")
    assert {tuple(r) for r in both.collect()} == {("CN", "中国"), ("JP", "日本")}
    only = lf.load_lookup_csv(spark, gbk, encoding="GBK")
    assert [tuple(r) for r in only.collect()] == [("JP", "日本")]


def test_write_jdbc(spark, monkeypatch):
    """The settings handed to Spark; no database is started for this."""
    seen = {}

    class Writer(DataFrameWriter):
        def format(self, source):
            seen["format"] = source
            return self

        def options(self, **options):
            seen.update(options)
            return self

        def mode(self, mode):
            seen["mode"] = mode
            return self

        def save(self):
            seen["saved"] = True

    monkeypatch.setattr(DataFrame, "write", property(Writer))
    lf.write_jdbc(spark.range(1), "jdbc:x", "named", connection={"user": "u"})
    assert seen == {
        "format": "jdbc",
        "url": "jdbc:x",
        "dbtable": "named",
        "batchsize": "1000",
        "user": "u",
        "mode": "overwrite",
        "saved": True,
    }


def test_jdbc_options():
    assert lf.jdbc_options("jdbc:x", "airports", lf.AIRPORT_COLUMN_TYPES) == {
        "url": "jdbc:x",
        "dbtable": "airports",
        "batchsize": "1000",
        "createTableColumnTypes": "name VARCHAR(255), type VARCHAR(255)",
    }
    assert "createTableColumnTypes" not in lf.jdbc_options("jdbc:x", "t")


def test_replace_table_replaces_all_partitions(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    tables.replace_table(df, "t_replace", ["p"])
    stored = tables.replace_table(df.where("p = 'a'"), "t_replace", ["p"])
    assert [tuple(r) for r in stored.collect()] == [(1, "a")]
    assert tables.read_table(spark, "t_replace", refresh=True).count() == 1


def test_replace_partitions_refuses_to_empty_the_table(spark):
    df = spark.createDataFrame([(1, "a")], "v int, p string")
    tables.replace_table(df, "t_refuse", ["p"])
    with pytest.raises(ValueError, match="dynamic"):
        tables.replace_partitions(df, "t_refuse", ["p"])


def test_replace_table_in_dynamic_mode(spark, dynamic_overwrite):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    tables.replace_table(df, "t_dynamic", ["p"])
    assert tables.replace_table(df.where("v = 1"), "t_dynamic", ["p"]).count() == 1


def test_replace_partitions_keeps_the_others_and_goes_by_name(spark, dynamic_overwrite):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    tables.replace_table(df, "t_parts", ["p"])
    tables.replace_partitions(
        spark.createDataFrame([("b", 9)], "p string, v int"), "t_parts", ["p"]
    )
    assert sorted(tuple(r) for r in spark.table("t_parts").collect()) == [(1, "a"), (9, "b")]


def test_replace_path_round_trip(spark, tmp_path):
    df = spark.range(100).select("id", (F.col("id") % 3).cast("int").alias("p"))
    path = str(tmp_path / "t")
    assert same_rows(df, tables.replace_path(df, path, ["p"]))
    less = tables.replace_path(df.where("p = 1"), path, ["p"])
    assert same_rows(less, df.where("p = 1"))


def test_large_partition_is_written_by_many_tasks(spark, tmp_path):
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        df = spark.range(0, 200_000, 1, 8).select(
            F.xxhash64("id").alias("v"), F.when(F.col("id") > 100, 1).otherwise(2).alias("p")
        )
        tables.replace_path(df, str(tmp_path / "t"), ["p"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    files = list((tmp_path / "t" / "p=1").glob("*.parquet"))
    assert len(files) > 4
    assert len(list((tmp_path / "t" / "p=2").glob("*.parquet"))) <= 2


def test_read_partition(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    path = str(tmp_path / "t")
    tables.replace_path(df, path, ["p"])
    assert [tuple(r) for r in tables.read_partition(spark, path, df.schema, p="b").collect()] == [
        (2, "b")
    ]
    assert tables.read_partition(spark, path, df.schema, p="z").isEmpty()
    assert tables.read_partition(spark, path + "/none", df.schema, p="a").isEmpty()


def test_read_day_prunes(spark):
    df = spark.createDataFrame(
        [(1, 2022, 5, 1), (2, 2022, 5, 2), (3, 2021, 5, 1)], "v int, year int, month int, day int"
    )
    stored = tables.replace_table(df, "t_days", ["year", "month", "day"])
    for found in (
        tables.read_day(spark, "t_days", "2022-05-02"),
        stored.where(tables.on_day("2022-05-02")),
    ):
        assert [r.v for r in found.collect()] == [2]
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "2022" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_json_lines(spark, tmp_path):
    path = tmp_path / "out"
    tables.write_json_lines(spark.createDataFrame([("1-transfer", 2.5)], "t string, f double"),
                            str(path))
    lines = [x for f in path.glob("part-*") for x in f.read_text().splitlines()]
    assert [json.loads(x) for x in lines] == [{"t": "1-transfer", "f": 2.5}]


def test_compressed_json_lines(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "JSON_FILE_ROWS", 300)
    trips = spark.range(2000, numPartitions=2).selectExpr("'1-transfer' route", "id", "id / 3 fare")
    tables.write_json_lines(trips, str(tmp_path / "plain"))
    tables.write_json_lines(trips, str(tmp_path / "small"), compression="gzip")
    size = lambda name: sum(f.stat().st_size for f in (tmp_path / name).glob("part-*"))
    assert size("small") * 3 < size("plain")
    assert len([*(tmp_path / "small").glob("part-*.json.gz")]) == 8
    assert same_rows(trips, spark.read.schema(trips.schema).json(str(tmp_path / "small")))


def test_database(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS air")
    tables.use_database(spark, "air")
    assert spark.catalog.currentDatabase() == "air"
    tables.use_database(spark, "default")


def test_scratch_is_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch.scratch_root(spark).startswith(shared)
    df = spark.range(5)
    stored = scratch.materialize(df, "numbers")
    assert same_rows(df, stored)
    assert stored.inputFiles()[0].removeprefix("file://").startswith(shared)


def test_no_local_scratch_on_a_cluster(monkeypatch):
    class Context:
        applicationId = "some-cluster-app"
        master = "yarn"

        @staticmethod
        def getCheckpointDir():
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.scratch_root(Session())


def _by_day(spark, path):
    days = [dt.date(2022, 4, 1) + dt.timedelta(days=i) for i in range(40)]
    rows = [(i, d.year, d.month, d.day) for i, d in enumerate(days * 3)]
    df = spark.createDataFrame(rows, "id int, year int, month int, day int")
    tables.replace_path(df, path, ["year", "month", "day"])
    return df


def test_days_of_a_catalog_table(spark, tmp_path):
    df = _by_day(spark, f"{tmp_path}/days")
    stored = tables.register_table(spark, "t_registered_days", f"{tmp_path}/days")
    assert same_rows(df, stored)
    one = tables.read_day(spark, "t_registered_days", "2022-04-05")
    assert sorted(r.id for r in one.collect()) == [4, 44, 84]
    plan = one._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("ReadSchema")[0]
    assert all(f"{c}#" in filters for c in ("year", "month", "day"))
    asked = [(dt.date(2022, 4, 5),), (dt.date(2022, 5, 1),), (dt.date(1999, 1, 1),), (None,)]
    days = spark.createDataFrame([*asked, asked[0]], "day date")
    some = tables.read_days(spark, "t_registered_days", days)
    assert sorted(r.id for r in some.collect()) == [4, 30, 44, 70, 84, 110]
    assert "dynamicpruning" in some._jdf.queryExecution().executedPlan().toString()
    assert tables.read_days(spark, "t_registered_days", days.limit(0)).isEmpty()


def test_two_loads_of_a_registered_table(spark, tmp_path, dynamic_overwrite):
    _by_day(spark, f"{tmp_path}/loads")
    tables.register_table(spark, "t_by_loads", f"{tmp_path}/loads")
    new = spark.createDataFrame([(-1, 5, 2022, 4), (-2, 1, 2030, 1)], "id int, day int, year int, month int")
    tables.replace_partitions(new, "t_by_loads", ["year", "month", "day"])
    rows = tables.read_table(spark, "t_by_loads", refresh=True).collect()
    assert sorted(r.id for r in rows if (r.month, r.day) == (4, 5)) == [-1]
    assert len(rows) == 120 - 3 + 2 and {r.id for r in rows if r.year == 2030} == {-2}


def test_at_most_two_files_a_folder(spark, tmp_path):
    """But for a folder that holds a third of all rows, which many tasks write."""
    day = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).cast("int")
    df = spark.range(30_000).withColumn("day", day).withColumn("text", F.sha2(F.col("id").cast("string"), 256))
    tables.replace_path(df, f"{tmp_path}/files", ["day"])
    files = {p.name: len(list(p.glob("*.parquet"))) for p in (tmp_path / "files").glob("day=*")}
    assert files.pop("day=0") >= 2
    assert len(files) == 49 and max(files.values()) <= 2
    assert same_rows(df, spark.read.parquet(f"{tmp_path}/files"))


TRICKY = [
    ["1", "plain", "x"],
    ["2", 'say ""hi""', "a, b"],
    ["3", "two\nlines", ""],
    ["4", 'quote at end""', 'only ""'],
    ["5", "\n\n", "after blank lines"],
    ["6", "é 中 \U0001f600", "long " * 40],
]


def _csv_text(records, end="\n"):
    def field(x):
        return f'"{x}"' if any(c in x for c in '",\n') else x

    return end.join([",".join(["id", "name", "note"]), *[",".join(map(field, r)) for r in records]])


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_large_csv_is_read_by_several_tasks(spark, tmp_path, end):
    """Ranges of a hundred bytes: records and quoted line breaks cross many of them."""
    records = [[f"{i}", *TRICKY[i % 6][1:]] for i in range(60)]
    (tmp_path / "a.csv").write_bytes((_csv_text(records, end) + end + end).encode())
    (tmp_path / "b.csv").write_bytes(_csv_text([["99", "x" * 700 + "\n" + "y" * 700, "wide"]], end).encode())
    paths = [f"{tmp_path}/a.csv", f"{tmp_path}/b.csv"]
    whole = lf._read_whole_files(spark, paths, "UTF-8")
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    old = [spark.conf.get(n) for n in names]
    for n, v in zip(names, ("100", "0")):
        spark.conf.set(n, v)
    try:
        lines = lf._lines(spark, paths, "UTF-8")
        assert lines.rdd.getNumPartitions() > 20
        got = sorted(map(tuple, lf.load_lookup_csv(spark, paths).collect()))
    finally:
        for n, v in zip(names, old):
            spark.conf.set(n, v)
    assert got == sorted(map(tuple, whole.collect())) and len(got) == 61
    unquoted = [[r[0], r[1].replace('""', '"'), r[2].replace('""', '"') or None] for r in records]
    assert sorted(map(tuple, unquoted)) == [r for r in got if r[0] != "99"]


def test_quotes_that_open_nothing():
    assert not lf.ends_inside('5" pipe,x', False)
    assert lf.ends_inside('a,"open', False) and lf.ends_inside('still, "" here', True)
    assert not lf.ends_inside('end",next', True)
    assert lf.ends_inside('end",",', True)
    assert not lf.ends_inside('"a ""b"" c","d"', False) and lf.ends_inside('"', False)


def test_empty_rows_and_a_file_of_two_columns(spark, tmp_path):
    (tmp_path / "c.csv").write_text('Kod,Nazwa\nNA,Namibia\n,\n\n"PL","Po\nland"\n')
    (tmp_path / "d.csv").write_text("Kod,Nazwa\nDE,Germany\n")
    df = lf.countries_table(lf.load_lookup_csv(spark, str(tmp_path)))
    assert sorted(map(tuple, df.collect())) == [("DE", "Germany"), ("NA", "Namibia"), ("PL", "Po\nland")]
    assert df.columns == ["code", "name"]
    (tmp_path / "e.csv").write_text("Kod,Inna\nFR,France\n")
    with pytest.raises(Exception, match="another header"):
        lf.load_lookup_csv(spark, str(tmp_path)).collect()
    (tmp_path / "only").mkdir()
    (tmp_path / "only" / "f.csv").write_text("Kod,Nazwa\n")
    assert lf.load_lookup_csv(spark, f"{tmp_path}/only").isEmpty()


def test_derived_flights_are_stored_small(spark, monkeypatch):
    from workload import derive

    ids = [(f"{i}-1-{7 * i}-3-{i * i}", i) for i in range(50)]
    monkeypatch.setitem(
        derive.DERIVED, "flights", lambda s, d: s.createDataFrame(ids, "leg_id string, n int")
    )
    kept = derive.stored(spark, "own-rows", "flights")
    assert sorted(map(tuple, kept.collect())) == sorted(ids)
    assert all(".zstd." in f for f in kept.inputFiles())

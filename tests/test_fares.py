from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from skyledger.operators.features import best_time_label, fare_features, route_price_rule
from skyledger.operators.model import (
    as_expression,
    fit_numeric_trees,
    feature_stages,
    hash_fraction,
    load_model,
    sample_rows,
    save_model,
    split_rows,
    train_fare_model,
    tree_table,
)
from skyledger.operators.reports import rmse, stitched_share
from skyledger.operators.scoring import recommend, scenario_grid
from skyledger.operators.segments import segment_fact
from tests.data import raw, same_rows

FARES = [
    ("a", 100.0),
    ("a", 105.0),
    ("a", 105.1),
    ("a", None),
    ("b", None),
    ("c", 7.0),
    (None, 10.0),
    (None, 20.0),
]


@pytest.fixture(params=["10485760", "-1"])
def broadcast_limit(spark, request):
    name = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(name)
    spark.conf.set(name, request.param)
    yield
    spark.conf.set(name, old)


def test_label(spark, broadcast_limit):
    df = spark.createDataFrame(FARES, "leg_id string, total_fare double")
    labels = best_time_label(df)
    assert labels.columns == ["leg_id", "total_fare", "is_best_time_to_buy"]
    got = sorted(labels.collect(), key=str)
    best = {("a", 100.0), ("a", 105.0), ("c", 7.0), (None, 10.0)}
    assert len(got) == len(FARES)
    for r in got:
        assert r.is_best_time_to_buy == ((r.leg_id, r.total_fare) in best)


def test_label_equals_window_with_a_hot_leg_and_copies(spark, broadcast_limit):
    leg = F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 97).cast("string"))
    fare = F.when(F.col("id") % 2 == 0, 50.0).otherwise((F.col("id") % 60 + 48).cast("double"))
    df = spark.range(3000).select(leg.alias("leg_id"), fare.alias("total_fare"))
    window = df.selectExpr(
        "leg_id",
        "total_fare",
        "if(total_fare <= min(total_fare) over (partition by leg_id) * 1.05D, 1, 0) "
        "as is_best_time_to_buy",
    )
    labels = best_time_label(df)
    assert same_rows(window, labels)
    plan = labels._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" not in plan and plan.count("Range (") == 1


def test_features_drop_rows_without_a_flight_date(spark):
    fact = spark.createDataFrame(
        [("a", 1.0, 3, 1, 2, 3, 4, 9), ("b", 1.0, 3, 1, 2, 3, 4, 0)],
        "leg_id string, total_fare float, search_to_flight_days int, "
        "departure_airport_fk bigint, arrival_airport_fk bigint, airline_fk bigint, "
        "aircraft_fk bigint, flight_date_fk bigint",
    )
    dates = spark.createDataFrame([(9, 5, 2, 17)], "date_fk bigint, month int, "
                                  "day_of_week int, week_of_year int")
    rows = fare_features(fact, dates).collect()
    assert [(r.leg_id, r.flight_month, r.flight_day_of_week, r.flight_week_of_year)
            for r in rows] == [("a", 5, 2, 17)]


def routes(spark):
    return spark.createDataFrame(
        [(1, 2, 100.0), (1, 2, 120.0), (2, 1, None)],
        "departure_airport_fk bigint, arrival_airport_fk bigint, total_fare double",
    )


def test_route_rule(spark):
    rules = {r.departure_airport_fk: r.best_buy_threshold
             for r in route_price_rule(routes(spark)).collect()}
    assert rules == {1: 105.0, 2: None}


def test_scenario_grid(spark):
    rules = route_price_rule(routes(spark))
    grid = scenario_grid(rules, dt.date(2022, 1, 1))
    assert grid.count() == 2 * 36
    days = [r.search_to_flight_days for r in
            grid.select("search_to_flight_days").distinct().orderBy("search_to_flight_days")
            .collect()]
    assert days == list(range(1, 181, 5))
    first = grid.orderBy("date").first()
    assert first.date == dt.date(2022, 1, 2)
    assert (first.flight_day_of_week, first.flight_month, first.flight_week_of_year) == (
        1, 1, 52)
    assert first.airline_fk is None and first.aircraft_fk is None
    assert "Join" not in grid._jdf.queryExecution().optimizedPlan().toString()


def test_recommend(spark):
    rules = route_price_rule(routes(spark))
    grid = scenario_grid(rules, "2022-01-01").withColumn(
        "prediction", F.lit(104.995) + F.col("search_to_flight_days") / 1000
    )
    rows = recommend(grid, rules).where("departure_airport_fk = 1").orderBy("flight_date")
    got = [(r.predicted_fare, r.recommendation) for r in rows.limit(2).collect()]
    assert got == [(105.0, 1), (105.0, 0)]
    assert recommend(grid, rules).where(
        "departure_airport_fk = 2 and recommendation = 1"
    ).isEmpty()
    carried = scenario_grid(rules, "2022-01-01", ["best_buy_threshold"]).withColumn(
        "prediction", F.lit(104.995) + F.col("search_to_flight_days") / 1000
    )
    assert same_rows(recommend(grid, rules), recommend(carried))


def test_two_rules_for_a_route_fail(spark):
    rules = route_price_rule(routes(spark))
    grid = scenario_grid(rules, "2022-01-01").withColumn("prediction", F.lit(1.0))
    with pytest.raises(Exception, match="more than one row"):
        recommend(grid, rules.unionAll(rules)).collect()


def test_stitched_share(spark):
    source = raw(
        spark,
        {},
        {"leg_id": "L2", **{c: v.split("||")[0] for c, v in {
            "segments_departure_airport": "SFO",
            "segments_arrival_airport": "PHL",
            "segments_airline_name": "United",
            "segments_duration_in_seconds": "1",
            "segments_distance": "1",
            "segments_cabin_code": "coach",
            "segments_equipment_description": "Boeing"}.items()}},
        {"leg_id": "L3", "segments_airline_name": "United||United"},
    )
    rows = stitched_share(segment_fact(source)).collect()
    assert [(r.airline_name, r.tickets, r.stitched_tickets) for r in rows] == [
        ("Delta", 1, 1), ("United", 3, 2)]


def test_rmse(spark):
    df = spark.createDataFrame([(1.0, 4.0), (2.0, 6.0)], "y double, p double")
    assert df.agg(rmse(F.col("y"), F.col("p"))).first()[0] == pytest.approx(12.5**0.5)


def training(spark, n=400):
    i = F.col("id")
    return spark.range(n).select(
        i.cast("string").alias("leg_id"),
        (i % 7 * 30 + i % 5 * 10 + 100).cast("float").alias("total_fare"),
        F.when(i % 20 > 0, (i % 90).cast("int")).alias("search_to_flight_days"),
        (i % 5).alias("departure_airport_fk"),
        (i % 7).alias("arrival_airport_fk"),
        (i % 3).alias("airline_fk"),
        (i % 2).alias("aircraft_fk"),
        (i % 7 + 1).cast("int").alias("flight_day_of_week"),
        (i % 12 + 1).cast("int").alias("flight_month"),
        (i % 52 + 1).cast("int").alias("flight_week_of_year"),
    )


def test_train_save_load_and_score(spark, tmp_path):
    trained = train_fare_model(
        training(spark), fraction=1.0, identity=["leg_id"], maxIter=2, maxDepth=2
    )
    assert 0 < trained.rmse < 100
    save_model(trained.model, str(tmp_path / "model"))
    model = load_model(str(tmp_path / "model"))
    rules = route_price_rule(training(spark))
    scored = recommend(model.transform(scenario_grid(rules, "2022-01-01")), rules)
    assert scored.count() == rules.count() * 36
    assert scored.where("predicted_fare is null").isEmpty()


def test_unseen_and_missing_categories_code_as_zero(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    model = Pipeline(stages=feature_stages()).fit(training(spark))
    odd = training(spark, 1).withColumns(
        {"airline_fk": F.lit(None).cast("bigint"), "aircraft_fk": F.lit(99).cast("bigint")}
    )
    row = model.transform(odd).select(
        vector_to_array("airline_fk_vec").alias("a"), vector_to_array("aircraft_fk_vec").alias("b")
    ).first()
    assert set(row.a) == set(row.b) == {0.0}


def test_samples(spark):
    df = training(spark, 5000)
    keyed = sample_rows(df, 0.1, identity=["leg_id"])
    assert 350 < keyed.count() < 650
    assert same_rows(keyed, sample_rows(df.repartition(3), 0.1, identity=["leg_id"]))
    assert 350 < sample_rows(df, 0.1).count() < 650
    assert sample_rows(df, 1.0, identity=["leg_id"]).count() == 5000
    other = sample_rows(df, 0.1, seed=7, identity=["leg_id"])
    assert not same_rows(keyed, other)
    span = df.agg(F.min(hash_fraction(["leg_id"])), F.max(hash_fraction(["leg_id"]))).first()
    assert 0 <= span[0] < 0.01 and 0.99 < span[1] < 1


@pytest.mark.parametrize("identity", [None, ["leg_id"]])
def test_splits_are_disjoint_and_complete(spark, identity):
    df = training(spark, 2000)
    train, test = split_rows(df, identity=identity)
    assert same_rows(train.unionAll(test), df)
    assert train.join(test, "leg_id").isEmpty()
    assert 1500 < train.count() < 1700


def test_exported_trees_equal_the_model(spark):
    """Categories, numbers, missing and unseen values, as an expression of raw columns."""
    rows = training(spark, 600)
    trained = train_fare_model(rows, fraction=1.0, identity=["leg_id"], maxIter=4, maxDepth=4)
    odd = rows.limit(40).withColumns(
        {
            "airline_fk": F.when(F.col("airline_fk") % 2 == 0, F.lit(99)),
            "search_to_flight_days": F.lit(None).cast(rows.schema["search_to_flight_days"].dataType),
        }
    )
    both = rows.unionByName(odd)
    exported = as_expression(trained.model, both.schema)
    off = trained.model.transform(both).select(F.abs(F.col("prediction") - exported).alias("off"))
    assert off.agg(F.max("off")).first()[0] < 1e-9
    assert off.where("off is null").isEmpty()
    nodes = tree_table(trained.model, spark).collect()
    assert {n.tree for n in nodes} == {0, 1, 2, 3}
    inner = {(n.tree, n.node) for n in nodes if n.feature}
    assert {(t, c) for t, n in inner for c in (2 * n, 2 * n + 1)} == {
        (n.tree, n.node) for n in nodes if n.node > 1
    }


def test_a_tree_of_depth_one_splits_where_the_variance_falls_most(spark):
    fares = [(1, 5, 10.0), (1, 6, 12.0), (2, 5, 11.0), (3, 5, 40.0), (3, 6, 44.0), (4, 6, 42.0)]
    rows = spark.createDataFrame(fares, "a int, b int, total_fare double")
    model = fit_numeric_trees(rows, ["a", "b"], maxIter=1, maxDepth=1)
    nodes = {n.node: n for n in tree_table(model, spark).collect()}
    assert (nodes[1].feature, nodes[1].threshold) == ("a", 2.5)
    assert (nodes[2].value, nodes[3].value) == (11.0, 42.0)
    prices = rows.select(as_expression(model, rows.schema).alias("p")).collect()
    assert [r.p for r in prices] == [11.0, 11.0, 11.0, 42.0, 42.0, 42.0]

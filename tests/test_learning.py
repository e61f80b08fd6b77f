"""Features, forests and scoring: invariants and the interval against the trees themselves."""

import datetime
import json
import shutil

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from avspark import dims
from avspark.ml import features as ft
from avspark.ml import model as md
from avspark.ml import predict
from avspark.session import new_path
from avspark.sources import bindings, manifest

COLUMNS = ("flight_id", "origin", "destination", "distance_mi", "aircraft_type", "dep_hour", "day_of_week",
           "delay_minutes", "is_delayed", "scheduled_departure")


@pytest.fixture(scope="module")
def features(spark, sf_dir):
    """Flights whose delay depends on the hour, so that there is something to learn."""
    flights = bindings.ops_flights(spark, sf_dir, *COLUMNS)
    delay = F.when(F.col("dep_hour").between(14, 20), F.col("dep_hour") * 3.0).otherwise(2.0)
    flights = flights.withColumn("delay_minutes", delay).withColumn("is_delayed", (delay >= 15).cast("int"))
    network = dims.airports(spark, dims.NETWORK)
    return ft.build_features(flights, bindings.weather_obs(spark, sf_dir), network).cache()


@pytest.fixture(scope="module")
def path(spark):
    return new_path(spark, "model")


@pytest.fixture(scope="module")
def models(features, path):
    return md.load_or_train(md.split(features)[0], path, trees=12, regressor_depth=8, classifier_depth=6)


def test_feature_ranges(features):
    assert features.where("aircraft_type_encoded NOT BETWEEN 0 AND 3").count() == 0
    for c in ("origin_weather_score", "dest_weather_score", "route_congestion_score"):
        assert features.where(f"{c} IS NULL OR {c} < 0 OR {c} > 1").count() == 0


def test_weather_as_of_each_flight_is_an_option(spark, sf_dir):
    flights = bindings.ops_flights(spark, sf_dir, *COLUMNS)
    own = ft.build_features(flights, bindings.weather_obs(spark, sf_dir),
                            dims.airports(spark, dims.NETWORK), as_of="flight")
    assert own.count() == flights.count() and set(ft.FEATURES) <= set(own.columns)


def test_split_does_not_depend_on_partitioning(features):
    train, test = md.split(features)
    again, _ = md.split(features.repartition(7))
    assert train.count() + test.count() == features.count()
    assert 0.75 < train.count() / features.count() < 0.85
    assert train.select("flight_id").exceptAll(again.select("flight_id")).count() == 0


def test_evaluation_bounds(features, models):
    report = {(r.metric, r["class"]): r.value for r in md.evaluate(
        md.score(md.split(features)[1], models)).collect()}
    assert report[("mae", "all")] < 50 and report[("accuracy", "all")] > 0.55
    assert len(report) == 10 and all(v is None or v >= 0 for v in report.values())


def test_importances(models):
    assert set(models.importances) == set(ft.FEATURES)
    assert sum(models.importances.values()) == pytest.approx(1.0)


def test_scores_are_in_range(features, models):
    bad = md.score(features, models).where(
        "predicted_delay_minutes < 0 OR delay_probability NOT BETWEEN 0 AND 1 OR ci_low > ci_high OR ci_low < 0")
    assert bad.count() == 0


def test_interval_equals_percentiles_of_the_trees(features, models):
    some = features.orderBy("flight_id").limit(40)
    got = {r.flight_id: r for r in md.score(some, models).collect()}
    vectors = VectorAssembler(inputCols=list(ft.FEATURES), outputCol="f").transform(some).collect()
    for row in vectors:
        trees = [t.predict(row.f) for t in models.regressor.trees]
        low, high = np.percentile(trees, [10, 90])
        assert got[row.flight_id].ci_low == pytest.approx(max(0.0, low), abs=0.051)
        assert got[row.flight_id].ci_high == pytest.approx(high, abs=0.051)
        assert got[row.flight_id].predicted_delay_minutes == pytest.approx(max(0.0, np.mean(trees)), abs=0.051)


SETTINGS = {"trees": 3, "regressor_depth": 3, "classifier_depth": 3}


def test_saved_model_is_loaded_not_retrained(features, models, path, monkeypatch):
    monkeypatch.setattr(md, "train", None)   # calling it would fail
    again = md.load_or_train(md.split(features.repartition(7))[0], path, trees=12, regressor_depth=8, classifier_depth=6)
    assert again.importances == models.importances


def test_fingerprint_is_of_the_rows(features):
    some = features.limit(200).cache()
    whole = md.data_fingerprint(some)
    assert whole == md.data_fingerprint(some.repartition(5).orderBy(F.rand(1)))
    assert whole != md.data_fingerprint(some.union(some.limit(1)))
    assert whole != md.data_fingerprint(some.withColumn("delay_minutes", F.col("delay_minutes") + 1))
    assert md.data_fingerprint(some.limit(0)) == "0:0:0"


def test_new_data_and_new_settings_give_a_new_model(spark, features):
    path = new_path(spark, "renewed")
    some = features.limit(300).cache()
    md.load_or_train(some, path, **SETTINGS)
    versions = lambda: [v for v, _ in manifest.versions(spark, path)]
    md.load_or_train(some, path, **SETTINGS)
    assert versions() == [1]
    md.load_or_train(some.union(some.limit(1)), path, **SETTINGS)
    assert versions() == [2, 1]
    assert len(md.load_or_train(some, path, **{**SETTINGS, "trees": 4}).regressor.trees) == 4
    assert versions() == [3, 2, 1]


def test_broken_saves(spark, features, monkeypatch):
    """A save that breaks off is not seen; files that are gone are replaced by a new model."""
    path = new_path(spark, "broken")
    some = features.limit(300).cache()
    with pytest.raises(FileNotFoundError):
        md.load(spark, path)
    first = md.load_or_train(some, path, **SETTINGS)

    def dies(*args):
        raise RuntimeError("lost before publishing")

    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(manifest, "publish", dies)
        md.train(some.limit(100), path, **SETTINGS)
    assert md.load(spark, path).importances == first.importances
    folder = manifest.current(spark, path)["folder"]
    shutil.rmtree(f"{path}/data/{folder}/metadata")
    again = md.load_or_train(some, path, **SETTINGS)
    assert again.importances == first.importances
    assert manifest.current(spark, path)["folder"] != folder


def test_evaluation_takes_values_before_rounding(features, models):
    some = features.limit(50)
    raw = md.score(some, models, rounded=False)
    error = raw.agg(F.avg(F.abs(F.col("delay_minutes") - F.col("predicted_delay_minutes")))).first()[0]
    mae = md.evaluate(raw).where("metric = 'mae'").first().value
    assert mae == pytest.approx(error, abs=5e-5)


def test_class_weights_balance(features):
    weights = md.class_weights(features).collect()
    assert len({round(r.n * r.weight, 6) for r in weights}) == 1


def test_prediction_rows_and_ranking(features, models):
    stored = md.prediction_table(md.score(features, models), models)
    assert sum(json.loads(stored.first().feature_importances_json).values()) == pytest.approx(1.0)
    ranking = [r.importance for r in md.importance_ranking(stored).collect()]
    assert len(ranking) == 7 and ranking == sorted(ranking, reverse=True)


def test_importance_table_needs_no_scores(spark, models):
    table = [(r.feature, r.importance) for r in md.importance_table(spark, models).collect()]
    assert dict(table) == models.importances
    assert [v for _, v in table] == sorted((v for _, v in table), reverse=True)


def test_unknown_aircraft_scores(features, models):
    odd = features.limit(5).withColumn("aircraft_type", F.lit("Concorde")).withColumn(
        "aircraft_type_encoded", F.lit(0))
    assert md.score(odd, models).count() == 5


def test_every_request_is_answered(spark):
    """A known airport without a weather record has defaults; bad requests carry their errors."""
    columns = ("request_id long, origin string, destination string, scheduled_departure string, airline string, "
               "aircraft_type string, dep_hour int, day_of_week int, distance_mi double, row_limit int")
    ok = ("2024-03-01T08:30:00", dims.AIRLINES[0], dims.AIRCRAFT_TYPES[0], 8, 4, None, 10)
    requests = spark.createDataFrame([(1, "ATL", "LAX", *ok), (2, "ANC", "LAX", *ok), (3, "ZZZ", "LAX", *ok), (4, None, "L1", *ok)], columns)
    live = spark.createDataFrame(
        [(i, a, datetime.datetime(2024, 3, 1, 8), 10.0, 30.0, 1.0, 5.0, 50.0, 61) for i, a in enumerate(("ATL", "LAX"))],
        "event_id long, airport string, ts timestamp_ntz, temperature_c double, wind_speed_knots double, "
        "precipitation_mm_hr double, visibility_km double, cloud_cover_pct double, weather_code int")
    found = {r.request_id: r for r in predict.predict_delays(requests, live, dims.airports(spark), None).collect()}
    assert sorted(found) == [1, 2, 3, 4]
    assert found[1].errors == found[2].errors == ""
    assert found[2].weather_risk_score == max(ft.DEFAULT_WEATHER_SCORE, found[1].weather_risk_score)
    assert "wind 0 kn" in found[2].weather_summary
    assert found[3].errors == "origin_unknown" and found[3].blended_probability is None
    assert "destination_format" in found[4].errors


def test_fitting_rows_are_dealt_by_their_number_and_stand_next_to_like_ones(spark):
    rows = spark.range(3000).selectExpr("CAST(pmod(hash(id), 7) AS INT) AS kind", "CAST(id AS STRING) AS flight_id")
    dealt = md._dealt(rows, 3000, ["kind", "flight_id"])
    parts = dealt.rdd.glom().collect()
    assert len(parts) == 1 and sorted(parts[0]) == parts[0] and len(parts[0]) == 3000
    assert md._dealt(rows, 40 * md.TASK_ROWS[1], ["kind", "flight_id"]).rdd.getNumPartitions() == 40


def test_rows_with_the_same_inputs_are_scored_once(features, models, monkeypatch):
    scored = []
    answers = md._answers
    monkeypatch.setattr(md, "_answers", lambda rows, *more: scored.append(rows) or answers(rows, *more))
    rows = features.limit(50).cache()
    thrice = rows.union(rows).union(rows)
    found = md.score(thrice, models)
    assert found.columns[: len(features.columns)] == features.columns
    assert scored[0].count() == rows.select(*ft.FEATURES).distinct().count()
    each = [r for r in answers(rows, models, rows.columns, True).collect() for _ in range(3)]
    assert sorted(map(str, found.collect())) == sorted(map(str, each))


def test_rows_are_not_walked_from_the_roots_in_each_pass(models, features):
    regressor, classifier = models.pipeline.stages[1:]
    assert regressor.getCacheNodeIds() and classifier.getCacheNodeIds()


def test_kept_places_change_no_tree(spark, features):
    rows = VectorAssembler(inputCols=list(ft.FEATURES), outputCol="features").transform(features.limit(2000)).select(
        "features", F.col("delay_minutes").cast("double"), F.col("is_delayed").cast("double")).repartition(2).cache()
    regressor = lambda **how: RandomForestRegressor(
        labelCol="delay_minutes", numTrees=5, maxDepth=6, minInstancesPerNode=3, featureSubsetStrategy="all", seed=7, **how).fit(rows)
    classifier = lambda **how: RandomForestClassifier(
        labelCol="is_delayed", numTrees=5, maxDepth=6, minInstancesPerNode=3, featureSubsetStrategy="sqrt", seed=7, **how).fit(rows)
    for fit in (regressor, classifier):
        told = lambda model: model.toDebugString.split("\n", 1)[1]
        assert told(fit()) == told(fit(**md._PLACES))


def test_a_forest_is_fitted_in_parts_where_rows_fill_the_cores(spark, features, monkeypatch):
    """All trees and all rows, and the parts answer as one forest, also when loaded again."""
    monkeypatch.setattr(md, "TASK_ROWS", (10, 1000))
    monkeypatch.setattr(md, "PART_TREES", 4)
    cores = spark.sparkContext.defaultParallelism
    assert md._part_trees(cores * 10, 10, cores) == [10]
    assert md._part_trees(cores * 10 + 1, 10, cores) == [4, 3, 3]
    rows = features.limit(1500).withColumn("delay_minutes", F.pmod(F.hash("flight_id"), F.lit(60)).cast("double")).withColumn(
        "is_delayed", (F.col("delay_minutes") >= 15).cast("int")).cache()
    counts = []
    fit_and_save = md._fit_and_save
    monkeypatch.setattr(md, "_fit_and_save", lambda e, rows, path: counts.append((rows.count(), rows.rdd.getNumPartitions())) or fit_and_save(e, rows, path))
    path = new_path(spark, "parts")
    fitted = md.load_or_train(rows, path, trees=10, regressor_depth=5, classifier_depth=4)
    assert counts == [(1500, 2)] * 6
    assert [p.getNumTrees for p in fitted.regressors] == [p.getNumTrees for p in fitted.classifiers] == [4, 3, 3]
    trees = [t.toDebugString.split("\n", 1)[1] for t in fitted.regressor.trees]
    assert len(set(trees)) == len(trees) == 10  # other draws in each part
    assert sum(fitted.importances.values()) == pytest.approx(1.0)

    some = rows.orderBy("flight_id").limit(40)
    got = {r.flight_id: r for r in md.score(some, fitted, rounded=False).collect()}
    for row in VectorAssembler(inputCols=list(ft.FEATURES), outputCol="f").transform(some).collect():
        each = [t.predict(row.f) for t in fitted.regressor.trees]
        votes = sum(np.array(p.predictRaw(row.f).toArray()) for p in fitted.classifiers)
        found = got[row.flight_id]
        low, high = np.percentile(each, [10, 90])
        assert (found.predicted_delay_minutes, found.ci_low, found.ci_high) == pytest.approx((max(0, np.mean(each)), max(0, low), high))
        assert found.delay_probability == pytest.approx(votes[1] / votes.sum())
        assert found.delayed_predicted == (found.delay_probability > 0.5)
    monkeypatch.setattr(md, "train", None)   # calling it would fail
    again = md.load_or_train(rows, path, trees=10, regressor_depth=5, classifier_depth=4)
    assert {r.flight_id: r for r in md.score(some, again, rounded=False).collect()} == got
    assert again.importances == fitted.importances


def test_forests_are_fitted_on_all_rows_however_many(spark, features, monkeypatch):
    """As if there were a billion rows: none is left out."""
    monkeypatch.setattr(md, "data_fingerprint", lambda rows: "1000000000:0:0")
    monkeypatch.setattr(md, "TASK_ROWS", (10, 1 << 30))
    counts = []
    fit_and_save = md._fit_and_save
    monkeypatch.setattr(md, "_fit_and_save", lambda e, rows, path: counts.append(rows.count()) or fit_and_save(e, rows, path))
    md.train(features.limit(1500), new_path(spark, "all-rows"), **SETTINGS)
    assert counts == [1500, 1500]

"""Features, training, evaluation and scoring."""

from __future__ import annotations

import hashlib

from pyspark.sql import Window
from pyspark.sql import functions as F

from avspark import dims
from avspark.ml import features as ft
from avspark.ml import model as md
from avspark.ml import predict
from avspark.plans.ctes import congestion, fixed, haversine, rnd, with_ctes
from avspark.plans.flights import REQUESTS, VALIDATED
from avspark.plans.registry import query
from avspark.session import new_path, work_dir
from avspark.sources import bindings as b

_COLUMNS = ("flight_id", "origin", "destination", "distance_mi", "aircraft_type", "dep_hour", "day_of_week",
            "delay_minutes", "is_delayed")
_PINNED = """
    SELECT k.code AS airport, k.hour, o.weather_impact_score AS impact
    FROM (SELECT code, CAST(h AS INTEGER) AS hour, greatest(TIMESTAMP '2024-01-15'+to_hours(h), lo) AS t
          FROM network JOIN bounds ON airport=code, range(24) g(h)) k
    ASOF JOIN obs o ON o.airport=k.code AND k.t>=o.ts"""


def _network(spark):
    return dims.airports(spark, dims.NETWORK)


def _features(spark, sf_dir):
    flights = b.ops_flights(spark, sf_dir, *_COLUMNS)
    return ft.build_features(flights, b.weather_obs(spark, sf_dir), _network(spark))


def _models(spark, sf_dir):
    """The model of a data folder: trained on first use and when its rows or the settings change."""
    name = hashlib.md5(sf_dir.encode()).hexdigest()[:10]
    return md.load_or_train(md.split(_features(spark, sf_dir))[0], f"{work_dir(spark)}/delay-model-{name}")


@query("m1_h12_h13_u1_features", with_ctes(f"""
    SELECT flight_id, dep_hour, day_of_week, coalesce(po.impact, 0.3) AS origin_weather_score,
      coalesce(pd.impact, 0.3) AS dest_weather_score, distance_mi,
      CAST(list_position(['Airbus A320','Airbus A321','Boeing 737','Boeing 777'], aircraft_type)-1 AS INTEGER)
        AS aircraft_type_encoded,
      {congestion('origin', 'destination', 'dep_hour')} AS route_congestion_score
    FROM ops LEFT JOIN pinned po ON po.airport=origin AND po.hour=dep_hour
    LEFT JOIN pinned pd ON pd.airport=destination AND pd.hour=dep_hour""",
    "ops", "obs", "bounds", "network", pinned=_PINNED))
def m1(spark, sf_dir):
    return _features(spark, sf_dir).select("flight_id", *ft.FEATURES)


@query("m2_train_test_split", with_ctes("""
    SELECT flight_id, CASE WHEN ('0x'||substr(md5(flight_id),1,8))::BIGINT%10 < 8 THEN 'train' ELSE 'test' END AS part
    FROM perf""", "perf"))
def m2(spark, sf_dir):
    train, test = md.split(b.ops_flights(spark, sf_dir, "flight_id"))
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query("m4_class_weights", with_ctes("""
    SELECT is_delayed, CAST(count(*) AS BIGINT) AS n,
      sum(count(*)) OVER ()/(count(*) OVER ()*count(*))::DOUBLE AS weight FROM perf
    WHERE ('0x'||substr(md5(flight_id),1,8))::BIGINT%10 < 8 GROUP BY is_delayed""", "perf"))
def m4_weights(spark, sf_dir):
    return md.class_weights(md.split(b.ops_flights(spark, sf_dir, "flight_id", "is_delayed"))[0])


@query("m3_m4_m5_s13_train_and_evaluate")
def m5(spark, sf_dir):
    models = _models(spark, sf_dir)
    return md.evaluate(md.score(md.split(_features(spark, sf_dir))[1], models, rounded=False))


# What a model says depends on its trees; what must hold of it does not, and SQL tells it for each row.
@query("m3_m4_m5_evaluation_facts", with_ctes("""
    SELECT metric, class, CASE WHEN metric = 'support' THEN CAST(n AS DOUBLE) END AS exact_value, true AS in_bounds
    FROM (SELECT count(*) FILTER (WHERE is_delayed = 0) AS n0, count(*) FILTER (WHERE is_delayed = 1) AS n1 FROM perf
          WHERE ('0x'||substr(md5(flight_id),1,8))::BIGINT%10 >= 8),
      LATERAL (VALUES ('mae', 'all', NULL), ('accuracy', 'all', NULL), ('precision', 'on-time', NULL), ('recall', 'on-time', NULL),
        ('f1', 'on-time', NULL), ('support', 'on-time', n0), ('precision', 'delayed', NULL), ('recall', 'delayed', NULL),
        ('f1', 'delayed', NULL), ('support', 'delayed', n1)) t(metric, class, n)""", "perf"))
def m5_facts(spark, sf_dir):
    """Each measure with the range it must keep; the number of test flights of each class exactly.

    The delays of this data do not depend on the features, so a model can be no better than chance on
    them; that it learns where there is something to learn is tested on made-up delays.
    """
    report = m5(spark, sf_dir)
    bound = (
        F.when(F.col("metric") == "mae", F.col("value").between(0, 300)).when(F.col("metric") == "support", F.col("value") >= 0)
        .otherwise(F.col("value").between(0, 1)))
    return report.select(
        "metric", "class", F.when(F.col("metric") == "support", F.col("value")).alias("exact_value"), F.coalesce(bound, F.lit(False)).alias("in_bounds"))


@query("m7_score_facts", with_ctes("""
    SELECT flight_id, true AS delay_in_range, true AS interval_ordered, true AS probability_in_range, true AS class_fits FROM perf""", "perf"))
def m7_facts(spark, sf_dir):
    scored = md.score(_features(spark, sf_dir), _models(spark, sf_dir), rounded=False)
    p = F.col("delay_probability")
    return scored.select(
        "flight_id", F.col("predicted_delay_minutes").between(0, 300.0).alias("delay_in_range"),
        (F.col("ci_low").between(0, F.col("ci_high"))).alias("interval_ordered"), p.between(0, 1).alias("probability_in_range"),
        ((F.col("delayed_predicted") == 1) == (p > 0.5)).alias("class_fits"))


@query("s12_s14_prediction_facts", with_ctes(f"""
    SELECT flight_id, {len(ft.FEATURES)} AS n_features, true AS in_range, 1.0::DOUBLE AS importance_sum FROM perf""", "perf"))
def s14_facts(spark, sf_dir):
    """The stored importances of each flight, read back from their JSON."""
    values = F.map_values(F.from_json("feature_importances_json", "map<string,double>"))
    return s14(spark, sf_dir).select(
        "flight_id", F.size(values).alias("n_features"), F.forall(values, lambda v: v.between(0, 1)).alias("in_range"),
        F.round("importance_sum", 6).alias("importance_sum"))


@query("m6_t7_importance_facts", f"""
    SELECT feature, true AS in_range, true AS ranked, 1.0::DOUBLE AS importance_sum FROM (VALUES {', '.join(f"('{f}')" for f in ft.FEATURES)}) t(feature)""")
def m6_facts(spark, sf_dir):
    ranking = t7(spark, sf_dir)
    # Seven rows, one a feature.
    every = Window.partitionBy()
    before = F.lag("importance").over(every.orderBy("_row"))
    return ranking.withColumn("_row", F.monotonically_increasing_id()).select(
        "feature", F.col("importance").between(0, 1).alias("in_range"), F.coalesce(before >= F.col("importance"), F.lit(True)).alias("ranked"),
        F.round(F.sum("importance").over(every), 6).alias("importance_sum"))


@query("m7_score_flights")
def m7(spark, sf_dir):
    models = _models(spark, sf_dir)
    return md.score(_features(spark, sf_dir), models).select(
        "flight_id", "predicted_delay_minutes", "delay_probability", "ci_low", "ci_high")


@query("s12_s14_prediction_table")
def s14(spark, sf_dir):
    models = _models(spark, sf_dir)
    path = new_path(spark, "predictions")
    md.prediction_table(md.score(_features(spark, sf_dir), models), models).write.parquet(path)
    stored = spark.read.parquet(path)
    return stored.withColumn(
        "importance_sum", F.aggregate(
            F.map_values(F.from_json("feature_importances_json", "map<string,double>")),
            F.lit(0.0), lambda a, x: a + x)
    ).drop("created_at")


@query("m6_t7_importance_ranking")
def t7(spark, sf_dir):
    return md.importance_table(spark, _models(spark, sf_dir))


@query("m8_predict_delays")
def m8(spark, sf_dir):
    return predict.predict_delays(
        b.requests(spark, sf_dir), b.live_weather(spark, sf_dir), dims.airports(spark), _models(spark, sf_dir))


@query("m8_predict_delays_without_model", with_ctes(f"""
    SELECT request_id, v.origin, v.destination, {rnd('r', 3)} AS blended_probability,
      {rnd('r*90.0', 1)} AS expected_delay_minutes, r AS weather_risk_score,
      CASE WHEN r>0.6 THEN 'HIGH' WHEN r>0.35 THEN 'MODERATE' ELSE 'LOW' END AS risk_label, 'low' AS confidence,
      'Origin: wind '||{fixed('wind_speed_knots', 0)}||' kn, vis '||{fixed('visibility_km', 1)}||' km, precip '
        ||{fixed('precipitation_mm_hr', 1)}||' mm/h. Route max risk: '||{fixed('r', 2)}||'.' AS weather_summary,
      'ML model unavailable — delay probability driven entirely by live weather risk score '||{fixed('r', 2)}||'.'
        AS explanation, '' AS errors
    FROM (SELECT v.request_id, v.origin, v.destination,
            greatest(coalesce(o.risk_score, 0.3::DOUBLE), coalesce(d.risk_score, 0.3::DOUBLE)) AS r,
            coalesce(o.wind_speed_knots, 0.0::DOUBLE) AS wind_speed_knots,
            coalesce(o.visibility_km, 16.0::DOUBLE) AS visibility_km,
            coalesce(o.precipitation_mm_hr, 0.0::DOUBLE) AS precipitation_mm_hr
          FROM ({VALIDATED}) v LEFT JOIN latest_live o ON o.airport=v.origin
          LEFT JOIN latest_live d ON d.airport=v.destination
          WHERE NOT regexp_matches(errors, 'origin|destination|departure|airline|aircraft')) v
    UNION ALL
    SELECT request_id, origin, destination, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
      array_to_string(list_filter(string_split(errors, ','),
        lambda e: regexp_matches(e, 'origin|destination|departure|airline|aircraft')), ',')
    FROM ({VALIDATED}) WHERE regexp_matches(errors, 'origin|destination|departure|airline|aircraft')""",
    "ops", "latest_live", requests=REQUESTS))
def m8_fallback(spark, sf_dir):
    return predict.predict_delays(
        b.requests(spark, sf_dir), b.live_weather(spark, sf_dir), dims.airports(spark), None)


_BY_HOUR = "'origin_format|destination_format|aircraft_type|dep_hour|day_of_week|distance_mi'"
_HOUR_REQUESTS = dict(
    requests=REQUESTS, pinned=_PINNED, valid=VALIDATED,
    asked=f"""SELECT *, array_to_string(list_filter(string_split(errors, ','), lambda e: regexp_matches(e, {_BY_HOUR})), ',') AS wrong FROM valid""",
    inputs=f"""
    SELECT request_id, a.origin, a.destination, dep_hour, day_of_week, wrong AS errors,
      CASE WHEN wrong = '' THEN coalesce(po.impact, 0.3) END AS origin_weather_score,
      CASE WHEN wrong = '' THEN coalesce(pd.impact, 0.3) END AS dest_weather_score,
      CASE WHEN wrong = '' THEN coalesce(a.distance_mi, {rnd(haversine('o.lat', 'o.lon', 'd.lat', 'd.lon'), 1)}, 1500.0::DOUBLE) END AS distance_mi,
      CASE WHEN wrong = '' THEN CAST(list_position(['Airbus A320','Airbus A321','Boeing 737','Boeing 777'], aircraft_type)-1 AS INTEGER) END
        AS aircraft_type_encoded,
      CASE WHEN wrong = '' THEN {congestion('a.origin', 'a.destination', 'dep_hour')} END AS route_congestion_score
    FROM asked a LEFT JOIN pinned po ON po.airport=a.origin AND po.hour=dep_hour
    LEFT JOIN pinned pd ON pd.airport=a.destination AND pd.hour=dep_hour
    LEFT JOIN airports o ON o.code=a.origin LEFT JOIN airports d ON d.code=a.destination""")
_HOUR_TABLES = ("ops", "obs", "bounds", "network", "airports")


@query("m8_hour_request_features", with_ctes("SELECT * FROM inputs", *_HOUR_TABLES, **_HOUR_REQUESTS))
def m8_hour_features(spark, sf_dir):
    return predict.hour_request_features(
        b.requests(spark, sf_dir), b.weather_obs(spark, sf_dir), _network(spark), dims.airports(spark))


@query("m8_predict_at_hour", with_ctes("""
    SELECT *, errors = '' AS answered, true AS consistent FROM inputs""", *_HOUR_TABLES, **_HOUR_REQUESTS))
def m8_at_hour(spark, sf_dir):
    """Inputs exactly; of the answers what must hold whatever the trees: ranges, order, the label of the probability."""
    found = predict.predict_at_hour(
        b.requests(spark, sf_dir), b.weather_obs(spark, sf_dir), _network(spark), dims.airports(spark), _models(spark, sf_dir))
    p, label = F.col("delay_probability"), F.col("risk_label")
    fits = p.between(0, 1) & (F.col("predicted_delay_minutes") >= 0) & (F.col("ci_low") <= F.col("ci_high")) & (
        F.when(label == "HIGH", p > 0.6).when(label == "MODERATE", (p > 0.35) & (p <= 0.6)).otherwise(p <= 0.35))
    unanswered = p.isNull() & F.col("ci_low").isNull() & label.isNull()
    return found.withColumn("answered", p.isNotNull()).withColumn(
        "consistent", F.when(F.col("errors") == "", fits).otherwise(unanswered)).drop(
        "predicted_delay_minutes", "delay_probability", "ci_low", "ci_high", "risk_label")


@query("m8_predict_facts", with_ctes(f"""
    SELECT request_id, origin, destination, array_to_string(wrong, ',') AS errors,
      CASE WHEN len(wrong) = 0 THEN greatest(coalesce(o.risk_score, 0.3::DOUBLE), coalesce(d.risk_score, 0.3::DOUBLE)) END AS weather_risk_score,
      true AS consistent
    FROM (SELECT *, list_filter(string_split(errors, ','),
            lambda e: regexp_matches(e, 'origin|destination|departure|airline|aircraft')) AS wrong FROM ({VALIDATED})) v
    LEFT JOIN latest_live o ON o.airport=v.origin LEFT JOIN latest_live d ON d.airport=v.destination""",
    "ops", "latest_live", requests=REQUESTS))
def m8_facts(spark, sf_dir):
    """The blended answers: risk and errors exactly, the probability within what the blend allows."""
    final, r = F.col("blended_probability"), F.col("weather_risk_score")
    # 0.7 of a probability and 0.3 of the risk, rounded to three places; the delay is 90 minutes of it.
    fits = final.between(0.3 * r - 0.0006, 0.7 + 0.3 * r + 0.0006) & (F.abs(F.col("expected_delay_minutes") - 90 * final) <= 0.051)
    return m8(spark, sf_dir).select(
        "request_id", "origin", "destination", "errors", "weather_risk_score",
        F.when(F.col("errors") == "", fits).otherwise(final.isNull()).alias("consistent"))

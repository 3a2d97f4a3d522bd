"""Split, metrics, promotion and small training runs."""

from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

from delaylake.learning import (
    Scorer,
    classification_metrics,
    classifier_estimators,
    compiled,
    detached,
    display_name,
    minutes_scores,
    preprocessing_stages,
    production_version,
    promote,
    register,
    regression_metrics,
    regressor_estimators,
    score,
    stratified_split,
    train_classifiers,
    train_regressors,
    typed_features,
    with_split,
)
from delaylake.learning.scorers import predicted


def test_split_is_stratified_exact_and_repeatable(spark):
    df = spark.range(1000).withColumn("y", F.col("id") % 10 == 0)
    marked = with_split(df, ["id"], "y")
    shares = {r.y: r.n for r in marked.filter("is_test").groupBy("y").agg(F.count("*").alias("n")).collect()}
    # one bucket of 65536 is one row here, two if a digest prefix repeats
    assert abs(shares[True] - 20) <= 1 and abs(shares[False] - 180) <= 2
    again = with_split(df.repartition(7), ["id"], "y")
    assert marked.filter("is_test").select("id").exceptAll(again.filter("is_test").select("id")).isEmpty()
    other = with_split(df, ["id"], "y", seed=7)
    assert not marked.filter("is_test").select("id").exceptAll(other.filter("is_test").select("id")).isEmpty()


def test_split_keeps_copies_of_a_key_together_and_loses_no_row(spark):
    df = spark.range(300).withColumn("k", F.when(F.col("id") < 100, -1).otherwise(F.col("id")))
    train, test = stratified_split(df, ["k"])
    assert train.count() + test.count() == 300
    assert train.select("k").intersect(test.select("k")).isEmpty()


def test_split_of_null_labels(spark):
    df = spark.range(50).withColumn("y", F.when(F.col("id") % 2 == 0, "a"))
    assert with_split(df, ["id"], "y").groupBy("is_test").count().filter("is_test IS NULL").isEmpty()


def test_metrics_against_hand_counts(spark):
    pairs = [(1, 1)] * 3 + [(1, 0)] * 1 + [(0, 1)] * 2 + [(0, 0)] * 4
    m = classification_metrics(spark.createDataFrame(pairs, "y int, p int"), "y", "p").first()
    assert (m.accuracy, m.recall, m.precision) == (0.7, 0.75, 0.6)
    assert m.f1 == pytest.approx(2 * 0.6 * 0.75 / 1.35)
    none = classification_metrics(spark.createDataFrame([(0, 0)], "y int, p int"), "y", "p").first()
    assert tuple(none) == (1.0, 0.0, 0.0, 0.0)


def test_regression_metrics_against_formulas(spark):
    rng = random.Random(1)
    pairs = [(rng.uniform(15, 90), rng.uniform(15, 90)) for _ in range(40)]
    m = regression_metrics(spark.createDataFrame(pairs, "y double, p double"), "y", "p").first()
    mean = sum(y for y, _ in pairs) / 40
    sse, sst = sum((y - p) ** 2 for y, p in pairs), sum((y - mean) ** 2 for y, _ in pairs)
    assert m.mae == pytest.approx(sum(abs(y - p) for y, p in pairs) / 40)
    assert m.rmse == pytest.approx((sse / 40) ** 0.5)
    assert m.r2 == pytest.approx(1 - sse / sst)
    unpredicted = [(1000.0, None), (None, 7.0)]
    again = regression_metrics(spark.createDataFrame(pairs + unpredicted, "y double, p double"), "y", "p").first()
    assert tuple(again) == pytest.approx(tuple(m))
    for guess, r2 in ((5.0, 1.0), (6.0, 0.0)):
        assert regression_metrics(spark.createDataFrame([(5.0, guess)] * 3, "y double, p double"), "y", "p").first().r2 == r2


REGISTRY = "version int, stage string, metric double, model_path string, tags map<string,string>, name string"


def registry(spark, *rows):
    return spark.createDataFrame([(v, s, m, "", {}, n) for n, v, s, m in rows], REGISTRY)


def stages(df):
    return {(r.name, r.version): r.stage for r in df.collect()}


def test_promotion_larger_is_better(spark):
    base = [("m", 1, "Production", 0.5), ("m", 2, "Staging", 0.45), ("m", 3, "None", 0.1), ("other", 1, "Staging", 0.9)]
    better = stages(promote(registry(spark, *base, ("m", 4, "None", 0.6)), {"m": 4}, 0.4))
    assert better == {
        ("m", 1): "Archived", ("m", 2): "Archived", ("m", 3): "Archived", ("m", 4): "Production",
        ("other", 1): "Staging",
    }
    weaker = stages(promote(registry(spark, *base, ("m", 4, "None", 0.5)), {"m": 4}, 0.4))
    assert weaker[("m", 4)] == "Staging" and weaker[("m", 1)] == "Production" and weaker[("m", 2)] == "Archived"
    failing = stages(promote(registry(spark, *base, ("m", 4, "None", 0.39)), {"m": 4}, 0.4))
    assert failing[("m", 4)] == "Archived" and failing[("m", 2)] == "Staging" and failing[("m", 1)] == "Production"


def test_the_champion_is_compared_on_the_promoted_metric(spark):
    # Comparing with a metric no version carries would always promote the challenger.
    rows = registry(spark, ("m", 1, "Production", 0.46), ("m", 2, "None", 0.41))
    assert stages(promote(rows, {"m": 2}, 0.4)) == {("m", 1): "Production", ("m", 2): "Staging"}


def test_promotion_smaller_is_better(spark):
    base = [("r", 1, "Production", 25.0), ("r", 2, "Staging", 27.0)]
    run = lambda mae: stages(promote(registry(spark, *base, ("r", 3, "None", mae)), {"r": 3}, 30.0, "min", False))
    assert run(24.0) == {("r", 1): "Archived", ("r", 2): "Staging", ("r", 3): "Production"}
    assert run(26.0) == {("r", 1): "Production", ("r", 2): "Staging", ("r", 3): "Staging"}
    assert run(30.0)[("r", 3)] == "Staging"
    assert run(30.1) == {("r", 1): "Production", ("r", 2): "Staging"}
    first = promote(registry(spark, ("r", 1, "None", 29.0)), {"r": 1}, 30.0, "min", False)
    assert stages(first) == {("r", 1): "Production"}


def test_register_numbers_versions_per_name(spark):
    df, version = register(registry(spark, ("a", 4, "None", 0.1), ("b", 9, "None", 0.1)), "a", 0.5, "/p", {"t": "1"})
    assert version == 5 and df.count() == 3
    assert production_version(df, "a") is None


def table(spark, n=400):
    rng = random.Random(5)
    rows = []
    for i in range(n):
        hour, origin = rng.randrange(24), rng.choice(["NCE", "LYS", "BOD"])
        minutes = hour * 2.0 + (10 if origin == "NCE" else 0) + rng.uniform(-3, 3)
        rows.append((f"F{i}", origin, hour, None if i % 50 == 0 else rng.uniform(0, 30), minutes, minutes > 25, i % 3))
    return spark.createDataFrame(
        rows, "flight_id string, origin string, hour int, wind double, delay_minutes double, is_delayed boolean, code int"
    )


def test_classifiers_skip_failures(spark):
    estimators = {
        "LogisticRegression": LogisticRegression(maxIter=20),
        "Broken": LogisticRegression(labelCol="absent"),
        "Tree": DecisionTreeClassifier(),
    }
    fitted = train_classifiers(table(spark), ["flight_id"], ["origin", "code"], ["hour", "wind"], estimators=estimators)
    assert [f.name for f in fitted] == ["LogisticRegression", "Tree"]
    assert max(f.metrics["f1"] for f in fitted) > 0.8
    assert fitted[0].params["target"] == "is_delayed"
    with pytest.raises(RuntimeError):
        train_classifiers(table(spark), ["flight_id"], ["origin"], ["hour"], estimators={"b": estimators["Broken"]})


def test_regressors_find_types_and_need_fifty_rows(spark):
    df = table(spark)
    assert typed_features(df, ["origin", "hour", "code"]) == (["origin"], ["hour", "code"])
    fitted = train_regressors(
        df, ["flight_id"], ["origin", "hour", "wind", "not_there"],
        estimators={"LinearRegression": LinearRegression(), "Tree": DecisionTreeRegressor()},
    )
    assert {f.name for f in fitted} == {"LinearRegression", "Tree"} and fitted[0].metrics["mae"] < 4
    with pytest.raises(ValueError, match="50 are needed"):
        train_regressors(df.limit(60), ["flight_id"], ["origin", "hour"])


def test_unseen_and_null_values_still_get_a_score(spark):
    df = table(spark).withColumn("label", F.col("is_delayed").cast("double"))
    stages_ = preprocessing_stages(["origin"], ["hour", "wind"])
    model = detached(spark, Pipeline(stages=[*stages_, LogisticRegression(maxIter=10)]).fit(df))
    new = spark.createDataFrame([("ZZZ", 1, 1.0), (None, 23, None)], "origin string, hour int, wind double")
    out = score(new, model)
    assert out.columns == ["origin", "hour", "wind", "is_delayed"]
    assert [r.is_delayed for r in out.collect()] == [False, True]
    vectors = [r.v.toArray().tolist() for r in model.transform(new).select(F.col("origin_onehot").alias("v")).collect()]
    assert vectors == [[0.0] * 3, [0.0] * 3]


def test_minutes_are_scored_for_late_flights_only(spark):
    day = dt.date(2026, 3, 8)
    df = table(spark).withColumns({"flight_number": F.col("flight_id"), "origin_airport": F.col("origin")})
    model = Pipeline(stages=[*preprocessing_stages(["origin"], ["hour"]), LinearRegression(labelCol="delay_minutes")]).fit(df)
    some = df.filter("flight_id IN ('F1', 'F2', 'F3')").collect()
    p = spark.createDataFrame(
        [(r.flight_number, r.origin_airport, day, i != 1) for i, r in enumerate(some)],
        "flight_number string, origin_airport string, flight_date date, is_delayed boolean",
    )
    out = minutes_scores(df, p, detached(spark, model), day).collect()
    assert sorted(r.flight_id for r in out) == ["F1", "F3"]
    assert all(r.predicted_delay_minutes >= 0 and round(r.predicted_delay_minutes, 1) == r.predicted_delay_minutes for r in out)


def test_model_sets_and_names():
    assert list(classifier_estimators()) == ["RandomForest", "LogisticRegression", "XGBoost", "GradientBoosting"]
    assert list(regressor_estimators()) == [
        "LinearRegression", "RandomForestRegressor", "GradientBoostingRegressor", "XGBRegressor",
    ]
    assert display_name("XGBClassifier") == "XGBoost" and display_name("GradientBoostingClassifier") == "GradientBoosting"


def _odd_rows(seed, n):
    """Texts with quotes, NULL in every column, a number that is not one, a column without spread."""
    rng = random.Random(seed)
    text = lambda: rng.choice(["a", "b's", "c d", "é", None])
    number = lambda: rng.choice([None, float("nan"), *[rng.uniform(-5, 5) for _ in range(20)]])
    rows = []
    for i in range(n):
        t, x, code = text(), number(), rng.choice([None, 1, 2, 30])
        signal = (x or 0.0) * 2 + 3 * (t == "a") if x == x else 0.0
        rows.append((i, t, code, x, number(), 7, signal + rng.gauss(0, 1)))
    return rows


_ODD_DDL = "id int, t string, code int, x double, z double, flat int, y double"


ESTIMATORS = {
    "logistic": lambda: LogisticRegression(labelCol="label", threshold=0.4),
    "boosted classes": lambda: GBTClassifier(labelCol="label", maxIter=8, maxDepth=3, seed=1),
    "linear": lambda: LinearRegression(labelCol="y"),
    "tree": lambda: DecisionTreeRegressor(labelCol="y", maxDepth=6),
    "forest": lambda: RandomForestRegressor(labelCol="y", numTrees=7, maxDepth=4, seed=1),
    "boosted numbers": lambda: GBTRegressor(labelCol="y", maxIter=8, maxDepth=3, seed=1),
}


@pytest.mark.parametrize("kind", ESTIMATORS)
def test_a_compiled_model_predicts_what_its_stages_do(spark, kind):
    estimator = ESTIMATORS[kind]()
    train = spark.createDataFrame(_odd_rows(1, 300), _ODD_DDL).withColumn("label", (F.col("y") > 1).cast("double"))
    model = Pipeline(stages=[*preprocessing_stages(["t", "code"], ["x", "z", "flat"]), estimator]).fit(train)
    rows = spark.createDataFrame([*_odd_rows(2, 200), (999, "unseen", 99, None, None, None, 0.0)], _ODD_DDL)
    scorer = compiled(model)
    again = Scorer.from_json(scorer.to_json())
    assert again == scorer and set(scorer.columns) == {"t", "code", "x", "z", "flat"}
    expected = {r.id: r.prediction for r in model.transform(rows).select("id", "prediction").collect()}
    for r in rows.select("id", again.column().alias("p")).collect():
        assert (float(r.p) if isinstance(r.p, bool) else r.p) == pytest.approx(expected[r.id], abs=1e-9), r
    scored = predicted(rows, model, "found")
    assert scored.columns == [*rows.columns, "found"]
    assert "UDF" not in scored._jdf.queryExecution().executedPlan().toString()


def test_models_without_a_compiled_form_go_through_their_stages(spark, monkeypatch):
    train = spark.createDataFrame(_odd_rows(3, 200), _ODD_DDL).withColumn("label", (F.col("y") > 1).cast("double"))
    stages = preprocessing_stages(["t"], ["x"])
    forest = Pipeline(stages=[*stages, RandomForestClassifier(labelCol="label", numTrees=3, maxDepth=2, seed=1)]).fit(train)
    trees = Pipeline(stages=[*stages, GBTRegressor(labelCol="y", maxIter=2, maxDepth=2, seed=1)]).fit(train)
    assert compiled(forest) is None and compiled(trees) is not None
    found = {r.id: r.p for r in predicted(train, forest, "p").collect()}
    assert found == {r.id: r.prediction == 1.0 for r in forest.transform(train).collect()}
    monkeypatch.setattr("delaylake.learning.scorers.MOST_NODES", 1)
    assert compiled(trees) is None
    numbers = {r.id: r.p for r in predicted(train, trees, "p").collect()}
    assert numbers == {r.id: r.prediction for r in trees.transform(train).collect()}


def plain_boosting(xs, ys, binary, rounds, depth, step=0.3, extra=1.0, least=1.0):
    """The same trees, row by row: every value of every feature is a limit."""
    units = 1 << 20
    mean = sum(ys) / len(ys)
    base = math.log(mean / (1 - mean)) if binary else mean
    limits = [sorted({x[f] for x in xs})[:-1] for f in range(len(xs[0]))]
    margins, trees = [base] * len(xs), []
    score = lambda g, h: g * g / units / (h + extra * units)

    def grow(rows, gs, hs, level):
        g, h = sum(gs[i] for i in rows), sum(hs[i] for i in rows)
        best = (1e-6, None)
        for f, values in enumerate(limits) if level < depth else ():
            for limit in values:
                left = [i for i in rows if xs[i][f] <= limit]
                lg, lh = sum(gs[i] for i in left), sum(hs[i] for i in left)
                if lh >= least * units and h - lh >= least * units:
                    gain = score(lg, lh) + score(g - lg, h - lh) - score(g, h)
                    if gain > best[0] + 1e-12:
                        best = (gain, (f, limit, left))
        if best[1] is None:
            return -step * g / (h + extra * units)
        f, limit, left = best[1]
        inside = set(left)
        right = [i for i in rows if i not in inside]
        return (f, limit, grow(left, gs, hs, level + 1), grow(right, gs, hs, level + 1))

    def say(tree, x):
        while isinstance(tree, tuple):
            tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
        return tree

    for _ in range(rounds):
        chance = [1 / (1 + math.exp(-m)) for m in margins] if binary else margins
        gs = [round((c - y) * units) for c, y in zip(chance, ys)]
        hs = [round(max(c * (1 - c), 1e-16) * units) if binary else units for c in chance]
        tree = grow(list(range(len(xs))), gs, hs, 0)
        if not isinstance(tree, tuple):
            break
        trees.append(tree)
        margins = [m + say(tree, x) for m, x in zip(margins, xs)]
    return base, trees, margins


@pytest.mark.parametrize("objective", ["binary", "squared"])
def test_boosted_trees_equal_a_plain_version(spark, objective, tmp_path):
    from pyspark.ml.linalg import Vectors

    from delaylake.learning import HistogramBoosting, HistogramBoostingModel, boosting

    rng = random.Random(6)
    xs = [(rng.randrange(6) / 2, rng.randrange(9) - 4.0, float(rng.random() < 0.3)) for _ in range(260)]
    signal = [x[0] - (x[1] > 1) * 2 + 1.5 * x[2] * (x[0] > 1) + rng.gauss(0, 0.4) for x in xs]
    binary = objective == "binary"
    ys = [float(s > 0.8) for s in signal] if binary else signal
    df = spark.createDataFrame([(Vectors.dense(x), y) for x, y in zip(xs, ys)] + [(Vectors.dense(xs[0]), None)], ["features", "label"])
    original, boosting.FOLD = boosting.FOLD, 2  # rows are written again on the way
    try:
        model = HistogramBoosting(objective, rounds=5, maxDepth=3, maxBins=256).fit(df.repartition(3))
    finally:
        boosting.FOLD = original
    base, trees, margins = plain_boosting(xs, ys, binary, 5, 3)

    def same(got, expected):
        if not isinstance(expected, tuple):
            return got == pytest.approx(expected, abs=1e-5)
        return (got.feature, got.limit) == expected[:2] and same(got.left, expected[2]) and same(got.right, expected[3])

    assert model.base == pytest.approx(base) and len(model.trees) == len(trees)
    assert all(same(got, expected) for got, expected in zip(model.trees, trees))
    model.write().save(str(tmp_path / "model"))
    again = HistogramBoostingModel.load(str(tmp_path / "model"))
    found = [r.prediction for r in again.transform(df.where("label IS NOT NULL").coalesce(1)).collect()]
    expected = [float(m > 0) for m in margins] if binary else margins
    assert found == pytest.approx(expected, abs=1e-4)


def test_boosted_trees_in_a_pipeline(spark):
    from delaylake.learning import HistogramBoosting

    train = spark.createDataFrame(_odd_rows(4, 300), _ODD_DDL).withColumn("label", (F.col("y") > 1).cast("double"))
    for estimator in (HistogramBoosting("binary", rounds=3), HistogramBoosting("squared", labelCol="y", rounds=3)):
        model = Pipeline(stages=[*preprocessing_stages(["t", "code"], ["x", "z", "flat"]), estimator]).fit(train)
        model = PipelineModel([*model.stages[:-1], detached(spark, model.stages[-1])])
        expected = {r.id: r.prediction for r in model.transform(train).select("id", "prediction").collect()}
        scorer = compiled(model)
        for r in train.select("id", scorer.column().alias("p")).collect():
            assert float(r.p) == pytest.approx(expected[r.id], abs=1e-9)
    with pytest.raises(ValueError):
        Pipeline(stages=[*preprocessing_stages([], ["x"]), HistogramBoosting(rounds=1)]).fit(train.withColumn("label", F.lit(None).cast("double")))


def test_a_level_of_a_boosted_tree_is_one_pass_without_a_shuffle(spark, monkeypatch):
    """Neither a row per feature nor the sums of a few tasks are exchanged: a tree of three levels is three narrow passes."""
    from delaylake.learning import HistogramBoosting, boosting

    df = spark.range(400).select((F.col("id") % 2).cast("double").alias("label"), (F.col("id") % 37).cast("double").alias("x"))
    df = Pipeline(stages=preprocessing_stages([], ["x"])).fit(df).transform(df)
    kind, plans = type(df), []
    original = kind.toArrow
    monkeypatch.setattr(kind, "toArrow", lambda self: plans.append(self._jdf.queryExecution().executedPlan().toString()) or original(self))
    HistogramBoosting("binary", rounds=1, maxDepth=3).fit(df)
    assert 0 < len(plans) <= 3 and not any("Exchange" in p or "Generate" in p for p in plans)
    sums = []
    for direct in (64, 0):  # sums added by the driver, or by key before
        monkeypatch.setattr(boosting, "DIRECT", direct)
        sums.append(HistogramBoosting("binary", rounds=3).fit(df.repartition(5)).trees)
    assert sums[0] == sums[1]


def test_models_are_fitted_side_by_side(spark):
    """Each model waits until the other one has begun; one after the other neither would end."""
    import threading

    from delaylake.learning.training import train_classifiers

    barrier = threading.Barrier(2)

    class Waiting:
        def fit(self, rows):
            barrier.wait(60)
            return LogisticRegression(labelCol="label", maxIter=3).fit(rows)

    df = spark.range(200).select(F.col("id").alias("key"), (F.col("id") % 2 == 0).alias("is_delayed"), (F.col("id") % 7).alias("x"))
    fitted = train_classifiers(df, ["key"], [], ["x"], estimators={"a": Waiting(), "b": Waiting()})
    assert [f.name for f in fitted] == ["a", "b"]


def test_regressors_are_fitted_side_by_side(spark):
    import threading

    from delaylake.learning.training import train_regressors

    barrier = threading.Barrier(2)

    class Waiting:
        def fit(self, rows):
            barrier.wait(60)
            return LinearRegression(labelCol="label").fit(rows)

    df = spark.range(400).select(
        F.col("id").alias("key"), F.lit(True).alias("is_delayed"), (F.col("id") % 50 + 16.0).alias("delay_minutes"), (F.col("id") % 7).alias("x")
    )
    fitted = train_regressors(df, ["key"], ["x"], estimators={"a": Waiting(), "b": Waiting()}, min_rows=1)
    assert [f.name for f in fitted] == ["a", "b"]

"""Early stop, metrics, attribution and supported columns of the model."""

import math
import random

import pyarrow as pa
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from weft.plans import model as m


def test_stopping_round():
    assert m.stopping_round([5, 4, 3, 3, 3, 3, 3, 3, 1], patience=5) == (3, True)
    assert m.stopping_round([5, 4, 3, 2], patience=5) == (4, False)
    assert m.stopping_round([1, 2, 3, 4, 5, 6], patience=5) == (1, True)


@pytest.fixture(scope="module")
def noisy(spark):
    """A label that one feature tells in part: trees soon fit the noise."""
    rng = random.Random(4)
    rows = []
    for i in range(1500):
        x, junk = rng.random(), [rng.random() for _ in range(3)]
        rows.append((i, x, *junk, int(rng.random() < 0.25 + 0.5 * (x > 0.5))))
    df = spark.createDataFrame(rows, "customer_id long, tenure double, pagerank double, cc double, degree double, churn int")
    return m.with_split(df, "customer_id")


def test_forest_is_cut_to_its_best_round(noisy):
    ready = VectorAssembler(inputCols=["tenure", "pagerank", "cc", "degree"], outputCol="features").transform(
        noisy.withColumn("churn", F.col("churn").cast("double")))
    tr, va = ready.where("split = 'train'").cache(), ready.where("split = 'val'").cache()
    how = dict(maxDepth=4, stepSize=0.5, maxIter=60, minInstancesPerNode=2, subsamplingRate=0.5)
    model, curve = m.fit_stopped(tr, va, "churn", **how)
    k = model.getNumTrees
    assert k < 60 and len(curve) == k + 5
    assert min(curve) == curve[k - 1] and all(x > curve[k - 1] for x in curve[:k - 1])
    # the forest's own losses are the curve's up to its last tree
    assert model.evaluateEachIteration(va) == pytest.approx(curve[:k], abs=1e-12)


def test_metrics_agree_with_the_evaluators(spark):
    rng = random.Random(5)
    rows = [("train" if i % 3 else "test", rng.random() < 0.4, rng.randint(0, 40) / 40) for i in range(900)]
    df = spark.createDataFrame([(s, int(y), min(1.0, p + 0.2 * y)) for s, y, p in rows], "split string, y int, p double")
    df = df.withColumn("said", (F.col("p") >= 0.5).cast("int"))
    got = {r.split: r for r in m.classification_metrics(df, "y", "p", "said", "split").collect()}
    for split, r in got.items():
        part = df.where(F.col("split") == split).withColumn("y", F.col("y").cast("double"))
        for name, area in (("areaUnderROC", r.roc_auc), ("areaUnderPR", r.pr_auc)):
            ev = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="p", metricName=name, numBins=0)
            assert ev.evaluate(part) == pytest.approx(area, abs=1e-9)
        data = part.collect()
        hit, said, are = (sum(f(x) for x in data) for f in (lambda x: x.y and x.said, lambda x: x.said, lambda x: x.y))
        assert r.precision == pytest.approx(hit / said) and r.recall == pytest.approx(hit / are)
        assert r.f1 == pytest.approx(2 * hit / (said + are))
        clip = [min(max(x.p, 1e-15), 1 - 1e-15) for x in data]
        assert r.log_loss == pytest.approx(-sum(math.log(p if x.y else 1 - p) for x, p in zip(data, clip, strict=True)) / len(data))
    # a split of one class has no ROC area, scores that are never 1 no precision
    one = m.classification_metrics(spark.createDataFrame([("a", 0, 0.1, 0)], df.schema), "y", "p", "said", "split").first()
    assert (one.roc_auc, one.pr_auc, one.precision, one.recall, one.accuracy) == (None, None, 0.0, 0.0, 1.0)


def test_shapley_values(spark):
    rng = random.Random(6)
    df = spark.createDataFrame([(i, rng.random(), rng.random(), rng.random()) for i in range(60)], "id long, a double, b double, c double")
    examples, background = df.where("id < 7"), df.where("id >= 40")
    cols = ["a", "b", "c"]

    def values(score):
        got = m.shapley_values(lambda x: x.withColumn("score", score), examples, background, cols, "id").collect()
        assert len(got) == 7 * 3
        return {(r.id, r.feature): r for r in got}

    mean = background.agg(*[F.avg(c).alias(c) for c in cols]).first()
    line = values(2 * F.col("a") - 3 * F.col("b") + 1)
    for x in examples.collect():
        assert line[x.id, "a"].contribution == pytest.approx(2 * (x.a - mean.a))
        assert line[x.id, "b"].contribution == pytest.approx(-3 * (x.b - mean.b))
        assert line[x.id, "c"].contribution == pytest.approx(0)
    # with features that act together the sum still holds
    joint = F.col("a") * F.col("b") + F.sin(F.col("c") * 3) * F.col("a")
    base = background.select(F.avg(joint)).first()[0]
    got = values(joint)
    for x in examples.select("id", joint.alias("s")).collect():
        assert sum(got[x.id, c].contribution for c in cols) == pytest.approx(x.s - base)
        assert got[x.id, "a"].base == pytest.approx(base)


def test_extra_columns_and_unseen_values_change_no_score(spark, noisy):
    df = noisy.withColumn("region_asia", (F.col("customer_id") % 2).cast("int")).withColumn("note", F.lit("n"))
    model, cols, curve = m.train_stopped(df, "customer_id", "churn", maxIter=5, minInstancesPerNode=2)
    assert sorted(cols) == ["cc", "degree", "pagerank", "region_asia", "tenure"]
    plain = df.select("customer_id", "split", *cols)
    more = plain.withColumn("extra", F.lit(9.0)).withColumn("comm_size", F.lit(3))

    def scores(x):
        return {r.customer_id: r.score for r in m.score(model, x, cols, "churn").collect()}

    assert scores(plain) == scores(more)
    # a value that training has not seen encodes as zeros, as a null does
    assert scores(plain.withColumn("region_asia", F.lit(5))) == scores(plain.withColumn("region_asia", F.lit(6)))
    names = {r.feature for r in m.feature_importances(spark, model, cols, df).collect()}
    assert names == {"tenure", "pagerank", "cc", "degree", "region_asia=0.0", "region_asia=1.0"}


def test_permutation_importance_in_one_job(noisy):
    model, cols, _ = m.train_stopped(noisy, "customer_id", "churn", maxIter=10, maxDepth=3, stepSize=0.3)
    got = {r.feature: r.importance for r in m.permutation_importance(model, noisy, cols, "customer_id", "churn").collect()}
    assert set(got) == set(cols) and max(got, key=got.get) == "tenure"


def test_permuted_scores_are_those_of_the_model(noisy):
    """The permuted copies as the model itself scores them, one by one."""
    df = noisy.withColumn("region_asia", (F.col("customer_id") % 3).cast("int")).withColumn(
        "degree", F.when(F.col("customer_id") % 11 > 0, F.col("degree"))).withColumn(
        "segment_a", (F.col("tenure") > 0.3).cast("int")).withColumn("comm_size", F.lit(3.0))
    model, cols, _ = m.train_stopped(df, "customer_id", "churn", maxIter=12, maxDepth=4, stepSize=0.3, minInstancesPerNode=2,
                                     featureSubsetStrategy="all")
    got = {r.feature: r.importance for r in m.permutation_importance(
        model, df, cols, "customer_id", "churn", group_rows=100).collect()}
    test = df.where("split = 'test'").cache()

    def area(x):
        return m.roc_auc(m.score(model, x, cols, "churn"), "churn", "score").first()[0]

    base = area(test)
    for c in cols:
        permuted = m.permute_column(test, c, "customer_id", group_rows=100)
        assert got[c] == pytest.approx(base - area(permuted), abs=1e-9)
    assert got["comm_size"] == 0.0 and got["tenure"] != 0.0 and len(got) == len(cols)


def test_trees_are_read_as_they_score(noisy):
    df = noisy.withColumn("region_asia", (F.col("customer_id") % 3).cast("int"))
    model, cols, _ = m.train_stopped(df, "customer_id", "churn", maxIter=8, maxDepth=3, stepSize=0.3, minInstancesPerNode=2,
                                     featureSubsetStrategy="all")
    scored = m.score(model, df, cols, "churn").select("churn", "score", F.expr("features").alias("v")).collect()
    own = pa.array([r.v.toArray().tolist() for r in scored], pa.list_(pa.float64()))
    batch = pa.RecordBatch.from_arrays([pa.array([r.churn for r in scored]), own, own], names=["churn", "_own", "_other"])
    column_of = [1] * len(scored[0].v)
    parts = list(m.swapped_scores(m.read_trees(model.stages[-1]), column_of, 3, "churn", rows=700)([batch]))
    for copy in range(3):
        mine = [x for b in parts if b.column("feature")[0].as_py() == copy for x in b.column("score").to_pylist()]
        assert mine == pytest.approx([r.score for r in scored], abs=1e-12)


def test_permutation_makes_no_copy_of_the_rows(noisy, monkeypatch):
    """Rows go through the stages before the trees once, not once a feature."""
    model, cols, _ = m.train_stopped(noisy, "customer_id", "churn", maxIter=3, maxDepth=2)
    frames, whole = [], m.score
    monkeypatch.setattr(m, "score", lambda *a: frames.append(a[1]) or whole(*a))
    got = m.permutation_importance(model, noisy, cols, "customer_id", "churn")
    assert got.count() == len(cols)
    assert [f.count() for f in frames] == [noisy.where("split = 'test'").count()]

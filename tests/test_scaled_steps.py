"""Steps that run no round, fit or shuffle more than their result needs."""

import random
from collections import Counter

import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from weft.graph import PropertyGraph
from weft.operators import components, labels, paths, triangles
from weft.plans import model as m


def _graph(spark, ids, pairs):
    return PropertyGraph(spark.createDataFrame([(i,) for i in ids], "id long"),
                         spark.createDataFrame(pairs, "src long, dst long"))


def _hub_pairs(seed=3, n=60):
    """A hub with an edge to every vertex, some random edges, two tight groups."""
    rng = random.Random(seed)
    pairs = [(0, i) for i in range(1, n)] + [(rng.randrange(n), rng.randrange(n)) for _ in range(40)]
    for group in (range(1, 6), range(20, 26)):
        pairs += [(a, b) for a in group for b in group if a != b]
    return pairs


def _spied(monkeypatch, module):
    calls = []

    class Spy(module.KeyedEdges):
        def __init__(self, edges, *args, **kw):
            calls.append(("columns", edges.columns))
            super().__init__(edges, *args, **kw)

        def join(self, state, *args, **kw):
            calls.append(("join", kw.get("state_rows")))
            return super().join(state, *args, **kw)

    monkeypatch.setattr(module, "KeyedEdges", Spy)
    return calls


def _propagated(ids, pairs, rounds):
    at = {i: i for i in ids}
    for _ in range(rounds):
        got = {i: Counter() for i in ids}
        for a, b in pairs:
            got[b][at[a]] += 1
            got[a][at[b]] += 1
        at = {i: min(c, key=lambda x: (-c[x], x)) if (c := got[i]) else at[i] for i in ids}
    return at


def test_labels_stop_when_settled_and_stay_off_the_driver(spark, monkeypatch):
    calls = _spied(monkeypatch, labels)
    pairs = [(1, 2), (2, 3), (3, 1), (3, 4), (7, 8), (8, 9), (9, 7)]
    ids = [*range(1, 10), 50]
    got = {r.id: r.label for r in labels.label_scores(_graph(spark, ids, pairs), 24).collect()}
    assert got == _propagated(ids, pairs, 24)
    joins = [rows for what, rows in calls if what == "join"]
    assert len(joins) < 24 and set(joins) == {None}


@pytest.mark.parametrize("rounds", [1, 4, 7])
def test_labels_of_a_hub_and_of_a_pair_that_swaps(spark, rounds):
    pairs, ids = [*_hub_pairs(), (80, 81)], [*range(60), 80, 81]
    got = {r.id: r.label for r in labels.label_scores(_graph(spark, ids, pairs), rounds).collect()}
    assert got == _propagated(ids, pairs, rounds)


def test_triangles_take_the_list_along(spark, monkeypatch):
    calls = _spied(monkeypatch, triangles)
    pairs = _hub_pairs()
    near = {i: {b if a == i else a for a, b in pairs if i in (a, b)} - {i} for i in range(60)}
    want = {i: sum(len(near[i] & near[j]) for j in near[i]) // 2 for i in range(60)}
    got = {r.id: r["count"] for r in triangles.triangle_counts(_graph(spark, range(60), pairs)).collect()}
    assert got == want
    assert calls[0] == ("columns", ["u", "v", "nu"]) and len(calls) == 2


def test_strong_components_send_changed_labels_only(spark, monkeypatch):
    calls = _spied(monkeypatch, components)
    ring = [(i, i + 1) for i in range(12)] + [(12, 0)]
    got = {r.id: r.component for r in components.scc_labels(_graph(spark, range(14), [*ring, (12, 13)])).collect()}
    assert got == {i: 0 for i in range(13)} | {13: 13}
    sent = [rows for what, rows in calls if what == "join"]
    assert sent[0] == 13 and sent[1] == 12 and min(sent) == 1


@pytest.fixture(scope="module")
def noisy(spark):
    rng = random.Random(4)
    rows = [(i, x := rng.random(), rng.random(), int(rng.random() < 0.25 + 0.5 * (x > 0.5))) for i in range(600)]
    return m.with_split(spark.createDataFrame(rows, "customer_id long, tenure double, cc double, churn int"), "customer_id")


def test_no_tree_is_grown_again_after_the_stop(noisy, monkeypatch):
    fits = []

    class Spy(GBTClassifier):
        def __init__(self, **kw):
            fits.append(kw["maxIter"])
            super().__init__(**kw)

    ready = VectorAssembler(inputCols=["tenure", "cc"], outputCol="features").transform(
        noisy.withColumn("churn", F.col("churn").cast("double")))
    tr, va = ready.where("split = 'train'").cache(), ready.where("split = 'val'").cache()
    how = dict(maxDepth=3, stepSize=0.5, maxIter=40, minInstancesPerNode=2)
    monkeypatch.setattr(m, "GBTClassifier", Spy)
    model, curve = m.fit_stopped(tr, va, "churn", **how)
    k = model.getNumTrees
    assert fits == [20] and k < 20 and len(curve) == k + 5
    short = GBTClassifier(featuresCol="features", labelCol="churn", seed=42, **{**m.GBT_PARAMS, **how, "maxIter": k}).fit(tr)
    assert model.toDebugString.split("\n")[1:] == short.toDebugString.split("\n")[1:]
    assert list(model.featureImportances) == list(short.featureImportances) and model.treeWeights == short.treeWeights

    def scores(x):
        return {r.customer_id: r.probability for r in x.transform(va).collect()}

    assert scores(model) == scores(short)


def test_search_prepares_its_rows_once(noisy, monkeypatch):
    made = []
    whole = m.preprocessing
    monkeypatch.setattr(m, "preprocessing", lambda *a: made.append(a) or whole(*a))
    how = dict(maxIter=3, minInstancesPerNode=2)
    best, cols, table = m.search(noisy, "customer_id", "churn", {"maxDepth": [1, 2]}, **how)
    assert len(made) == 1 and cols == ["tenure", "cc"]
    got = {r.params: r.auc for r in table.collect()}
    for depth in (1, 2):
        model, cols, _ = m.train_stopped(noisy, "customer_id", "churn", maxDepth=depth, **how)
        val = m.score(model, noisy.where("split = 'val'"), cols, "churn")
        assert got[str({"maxDepth": depth})] == m.roc_auc(val, "churn", "score").first()[0]
    assert m.score(best, noisy, cols, "churn").where("score is null").isEmpty()


def test_landmark_rounds_go_by_the_frontier(spark, monkeypatch):
    g = _graph(spark, range(7), [(1, 0), (2, 0), (3, 1), (4, 1), (5, 3), (5, 3), (0, 5)])
    calls = _spied(monkeypatch, paths)
    found = {(r.id, r.landmark): r.distance for r in paths.shortest_path_rows(g, [0, 6, 99]).collect()}
    assert found == {(0, 0): 0, (6, 6): 0, (1, 0): 1, (2, 0): 1, (3, 0): 2, (4, 0): 2, (5, 0): 3}
    assert [rows for kind, rows in calls if kind == "join"] == [2, 2, 2, 1]


def test_landmark_distances_without_landmarks(spark):
    g = _graph(spark, range(3), [(1, 0), (2, 1)])
    assert paths.shortest_path_rows(g, [99]).collect() == []


def test_length_of_the_next_fit():
    steady = [1 - 0.01 * i for i in range(20)]
    assert m.next_length(steady, 277) == 277
    bent = [1 + 0.5 ** i for i in range(20)]  # nearly at its end
    assert m.next_length(bent, 277) == 80 and m.next_length(bent, 60) == 60
    flat = [1.0, *[0.5] * 19]
    assert m.next_length(flat, 277) == 80


def test_steady_curve_is_fitted_twice(noisy, monkeypatch):
    fits = []

    class Spy(GBTClassifier):
        def __init__(self, **kw):
            fits.append(kw["maxIter"])
            super().__init__(**kw)

    ready = VectorAssembler(inputCols=["tenure", "cc"], outputCol="features").transform(
        noisy.withColumn("churn", (F.col("tenure") + F.col("cc") > 1).cast("double")))
    tr, va = ready.where("split = 'train'").cache(), ready.where("split = 'val'").cache()
    how = dict(maxDepth=1, stepSize=0.005, maxIter=85, subsamplingRate=1.0, featureSubsetStrategy="all")
    monkeypatch.setattr(m, "GBTClassifier", Spy)
    model, curve = m.fit_stopped(tr, va, "churn", **how)
    assert fits == [20, 85] and len(curve) == 85 and model.getNumTrees == 85


def test_prepared_vectors_are_dense_and_keep_their_slots(noisy):
    df = noisy.withColumns({f"region_{i}": F.col("customer_id") % 2 for i in range(9)})
    fitted, ready, cols = m.prepare(df, "customer_id", "churn")
    plain = fitted.transform(m.coerce_numeric(df, cols))
    assert ready.schema["features"].metadata == plain.schema["features"].metadata
    made = {tuple(r.features) for r in ready.collect()}
    assert made <= {tuple(r.features.toArray()) for r in plain.collect()}
    assert {type(r.features).__name__ for r in ready.collect()} == {"DenseVector"}


def test_training_rows_derive_the_customers_once(spark, monkeypatch):
    from weft import registry
    from weft.plans import callgraph

    made, whole = [], callgraph.customers
    monkeypatch.setattr(callgraph, "customers", lambda *a: made.append(a) or whole(*a))
    monkeypatch.setattr(callgraph, "_SILVER", {})
    monkeypatch.setattr(registry, "_TRAINING", {})
    sf = "/root/testdata/sf0.001"
    rows = registry._training_rows(spark, sf)
    assert len(made) == 1
    kept = m.with_split(whole(spark, sf).where("total_charges is not null"), "customer_id")
    want = sorted(tuple(r) for r in kept.select("customer_id", "split", "tenure", "total_charges").collect())
    assert sorted(tuple(r) for r in rows.select("customer_id", "split", "tenure", "total_charges").collect()) == want

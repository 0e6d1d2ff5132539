"""Weak supervision: held-out accuracy, the label model, odd rows."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from weft.llm import registry, toxicity
from weft.llm.common import fold
from weft.sources.tables import table

SF = "/root/testdata/sf0.01"


def score(docs, labels):
    learn = F.coalesce(fold("doc_id", 3) != 1, F.lit(False))
    return toxicity.score(docs, labels, learn, {"doc_id": F.col("doc_id"), "votes": F.col("score")})


@pytest.fixture(scope="module")
def corpus(spark, odd_docs):
    """600 texts of made-up words; a fifth hold words that begin with
    ``zorb`` or an insult; then the odd rows, with clashing columns."""
    rng = random.Random(3)
    syllables = ["ka", "lo", "mi", "ter", "an", "so", "ru", "pel", "di", "va"]
    rows, marks = [], []
    for i in range(100, 700):
        words = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(rng.randint(8, 60))]
        bad = rng.random() < 0.2
        if bad:
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randint(0, len(words)), rng.choice(["moron", "zorb" + rng.choice(syllables)]))
        rows.append((i, " ".join(words), "xx", "s", 1, i, "y"))
        marks.append((i, int(bad) if rng.random() < 0.9 else None, "label"))
    docs = spark.createDataFrame(rows, odd_docs.schema).unionByName(odd_docs)
    return docs.withColumn("toxic", F.lit("?")).withColumn("unit", F.lit(1)), spark.createDataFrame(
        marks + [(100, 0, "again"), (None, 1, "none"), (9999, 1, "absent")], "doc_id long, toxic int, text string")


def test_weak_supervision(corpus, no_docs):
    docs, labels = corpus
    got = score(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    bad = {r.doc_id for r in docs.collect() if r.doc_id and any(
        w == "moron" or w.startswith("zorb") for w in (r.text or "").split())}
    held_out = [r for r in got if r.doc_id and r.doc_id >= 100 and zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    right = sum((r.score >= 0.7) == (r.doc_id in bad) for r in held_out)
    assert len(held_out) > 100 and right / len(held_out) > 0.95
    assert sum((r.posterior > 0.5) == (r.doc_id in bad) for r in held_out) / len(held_out) > 0.9
    empty = {r.score for r in got if r.doc_id in (3, 4, 5)}
    assert len(empty) == 1 and empty.pop() < 0.7  # null, empty and blank texts have no evidence
    assert len({r.score for r in got if r.doc_id in (1, 2)}) == 1  # equal texts
    assert [r.votes for r in got if r.doc_id == 100] == [100]  # the caller's column, not the internal one

    nothing = score(docs, labels.where("toxic = 0")).collect()
    assert len(nothing) == docs.count() and {(r.score, r.posterior) for r in nothing} == {(0.0, 0.0)}
    assert score(no_docs, labels).collect() == []


def test_held_out_labels_of_the_documents(spark):
    got = registry.op12_weak_toxicity(spark, SF).where("held_out").join(
        table(spark, SF, "labels").where("toxic is not null").select("doc_id", "toxic"), "doc_id").collect()
    assert all(r.predicted == 0 for r in got if r.toxic == 0)
    assert sum(r.predicted for r in got) / sum(r.toxic for r in got) >= 0.75
    assert all(r.predicted == int(r.score >= 0.7) for r in got)


def test_label_model_finds_accuracies_and_correlations():
    """Votes drawn from known chances: the model starts from few labelled rows
    and comes near them; a copied voter counts less than an independent one."""
    rng = np.random.default_rng(2)
    n, right = 20_000, [0.95, 0.8, 0.7]
    y = rng.random(n) < 0.3
    votes = np.stack([np.where(rng.random(n) < r, y, ~y) for r in right], axis=1)
    votes = np.column_stack([votes, votes[:, 2], votes[:, 2]]).astype(np.int8) + toxicity.CLEAN
    labelled = toxicity.LabelModel.sums(votes[:400], y[:400].astype(float), np.ones(400))
    model = toxicity.LabelModel.of(labelled, labelled)
    for _ in range(10):
        sums = toxicity.LabelModel.sums(votes, toxicity.sigmoid(model.logit(votes)), np.ones(n))
        model = toxicity.LabelModel.of(sums / n * 400, labelled)
    for k, r in enumerate(right):
        assert abs(model.chance[k, 1, toxicity.TOXIC] - r) < 0.06
        assert abs(model.chance[k, 0, toxicity.CLEAN] - r) < 0.06
    assert abs(model.prior - 0.3) < 0.05
    assert max(model.worth[2:]) < 0.5 < min(model.worth[:2])


def test_units_of_masked_words():
    t = toxicity.tokens_of(pa.array(["Mor*on, it's\tNAÏVE ", None, "  "]))
    assert t.size.tolist() == [3, 0, 0]
    assert [t.words[c].as_py() for c in t.codes] == ["moron", "its", "naïve"]
    row, unit, count = toxicity.unit_counts(t, pa.array(["mor", "moron$", "naïv", "zzz"], pa.large_string()))
    assert (row.tolist(), unit.tolist(), count.tolist()) == ([0, 0, 0], [0, 1, 2], [1, 1, 1])

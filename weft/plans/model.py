"""Churn model on Spark ML: split, impute, scale, boosted trees, metrics.

Everything runs as Spark jobs on the executors: the split is a hash of the
key (repeatable whatever the partitioning), training is ``GBTClassifier``
stopped by the validation rows after five rounds without gain, and every
report (metrics, confusion matrix, ROC and precision-recall points,
permutation importance, Shapley values) is an aggregate over a scored frame.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from weft.operators.iterate import cut
from weft.operators.sequence import numbered

# fixed values: the boosted-tree settings of the generated training script
GBT_PARAMS = dict(maxDepth=5, stepSize=0.0321, maxIter=277, subsamplingRate=0.418,
                  featureSubsetStrategy="0.342", minInstancesPerNode=19)
SPLIT = (60, 20, 20)  # train / val / test percent
PATIENCE = 5  # rounds without gain after which training stops
NUMBER_TYPES = {"int", "bigint", "double", "float", "smallint", "tinyint", "decimal", "boolean"}


def training_set(customer_features: DataFrame, graph_features: DataFrame, key: str = "customer_id") -> DataFrame:
    return customer_features.join(graph_features, key, "left")


def split_bucket(key, seed: int = 42):
    """0..99 from the first 32 bits of md5(key:seed) — repeatable whatever the
    partitioning, and reproducible outside Spark."""
    h = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))
    return F.pmod(F.conv(F.substring(h, 1, 8), 16, 10).cast("long"), F.lit(100))


def with_split(df: DataFrame, key: str, seed: int = 42, split=SPLIT) -> DataFrame:
    b = split_bucket(key, seed)
    t, v = split[0], split[0] + split[1]
    return df.withColumn("split", F.when(b < t, "train").when(b < v, "val").otherwise("test"))


# columns that the model takes; training and scoring tables may have others
NUMERIC = ("monthly_charges", "total_charges", "tenure", "degree", "in_degree", "out_degree", "in_degree_ratio",
           "out_degree_ratio", "pagerank", "trian_count", "cc", "comm_avg_monthly_charges", "comm_avg_total_charges",
           "comm_avg_tenure", "comm_size", "comm_dev_avg_monthly_charges", "comm_dev_avg_total_charges",
           "comm_dev_avg_tenure", "nghb_avg_monthly_charges", "nghb_avg_total_charges", "nghb_avg_tenure")
INDICATORS = ("segment_", "region_", "priority_")  # 0/1 columns of categories, one-hot encoded in training


def supported_columns(df: DataFrame) -> tuple[list[str], list[str]]:
    """(numeric, one-hot) columns of ``df`` that the model supports."""
    return ([c for c in df.columns if c in NUMERIC], [c for c in df.columns if c.startswith(INDICATORS)])


def coerce_numeric(df: DataFrame, cols) -> DataFrame:
    """Feature columns as double; unparseable values become null."""
    return df.select(*[F.expr(f"try_cast(`{c}` AS DOUBLE)").alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def preprocessing(num: list[str], onehot: list[str]) -> Pipeline:
    """Imputer (mean) -> scaler (mean 0, unit sample std) for numeric columns;
    ``onehot`` columns are indexed (unknown values kept in an extra slot) and
    one-hot encoded with the last slot dropped, so an unseen value encodes as
    all zeros; then the blocks are assembled."""
    imputed = [f"{c}__imp" for c in num]
    stages = [
        Imputer(strategy="mean", inputCols=num, outputCols=imputed),
        VectorAssembler(inputCols=imputed, outputCol="num_raw", handleInvalid="keep"),
        StandardScaler(withMean=True, withStd=True, inputCol="num_raw", outputCol="num_scaled"),
    ]
    blocks = ["num_scaled"]
    if onehot:
        idx = [f"{c}__idx" for c in onehot]
        vec = [f"{c}__ohe" for c in onehot]
        stages += [
            StringIndexer(inputCols=list(onehot), outputCols=idx, handleInvalid="keep"),
            OneHotEncoder(inputCols=idx, outputCols=vec, dropLast=True),
        ]
        blocks += vec
    return Pipeline(stages=[*stages, VectorAssembler(inputCols=blocks, outputCol="features")])


def build_pipeline(cols, label: str, seed: int = 42, onehot=(), **gbt) -> Pipeline:
    """Preprocessing and boosted trees in one pipeline, stopped by Spark's own
    rule on the rows with ``is_val``."""
    trees = GBTClassifier(featuresCol="features", labelCol=label, seed=seed, validationIndicatorCol="is_val",
                          **{**GBT_PARAMS, **gbt})
    num = [c for c in cols if c not in set(onehot)]
    return Pipeline(stages=[*preprocessing(num, list(onehot)).getStages(), trees])


def stopping_round(curve: list[float], patience: int = PATIENCE) -> tuple[int, bool]:
    """(best round from 1, whether ``patience`` rounds without gain followed)
    of validation losses by round."""
    best = 0
    for i, loss in enumerate(curve):
        if loss < curve[best]:
            best = i
        if i - best >= patience:
            return best + 1, True
    return best + 1, False


def next_length(curve: list[float], most: int) -> int:
    """Rounds of the next fit, after one of this curve that has not stopped:
    all of ``most`` where the second half of the rounds has gained at least
    half of what the first half has, as the end is then far and a fit between
    would only be grown again; else fourfold."""
    half = (len(curve) - 1) // 2
    falls = curve[half] - curve[-1] >= (curve[0] - curve[half]) / 2
    return most if falls else min(most, 4 * len(curve))


def first_trees(model: GBTClassificationModel, k: int) -> GBTClassificationModel:
    """``model`` with its first ``k`` trees only, as a fit of ``k`` rounds."""
    if k == model.getNumTrees:
        return model
    jvm, old = SparkSession.active()._jvm, model._java_obj
    trees = SparkSession.active().sparkContext._gateway.new_array(
        jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, k)
    weights = SparkSession.active().sparkContext._gateway.new_array(jvm.double, k)
    for i, (tree, weight) in enumerate(zip(old.trees()[:k], model.treeWeights[:k], strict=True)):
        trees[i], weights[i] = tree, weight
    cut_back = jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        old.uid(), trees, weights, model.numFeatures, model.numClasses)
    old.copyValues(cut_back, jvm.org.apache.spark.ml.param.ParamMap())
    # the count of rounds is that of the trees, as a fit of this length has it
    return model._copyValues(GBTClassificationModel(cut_back))._set(maxIter=k)


def fit_stopped(train_rows: DataFrame, val_rows: DataFrame, label: str, seed: int = 42, patience: int = PATIENCE,
                **gbt) -> tuple[GBTClassificationModel, list[float]]:
    """Boosted trees cut back to their best round, and the validation loss of
    each round up to ``patience`` after it.

    Spark's trees take no patience, but the first k trees of a fit do not
    depend on how many follow (each round has its own seed): longer fits run
    until the curve has stopped (``next_length``), and the last one is cut to
    its best round, so no tree of it is grown again."""
    params = {**GBT_PARAMS, **gbt}
    most = params.pop("maxIter")

    def fit(rounds: int) -> GBTClassificationModel:
        return GBTClassifier(featuresCol="features", labelCol=label, seed=seed, maxIter=rounds, **params).fit(train_rows)

    rounds = min(most, 4 * patience)
    while True:
        model = fit(rounds)
        curve = list(model.evaluateEachIteration(val_rows)) if not val_rows.isEmpty() else []
        best, stopped = stopping_round(curve, patience) if curve else (rounds, True)
        if stopped or rounds == most:
            break
        rounds = next_length(curve, most)
    return first_trees(model, best), curve[:best + patience]


def train_stopped(df: DataFrame, key: str, label: str, seed: int = 42, onehot: list[str] | None = None,
                  columns: list[str] | None = None, **gbt) -> tuple[PipelineModel, list[str], list[float]]:
    """(pipeline model, its columns, validation curve).  Only the supported
    ``columns`` and ``onehot`` columns are read; the preprocessing is fitted
    to the ``train`` rows, the trees stop by the ``val`` rows."""
    fitted, ready, cols = prepare(df, key, label, onehot, columns)
    trees, curve = fit_stopped(ready.where("split = 'train'"), ready.where("split = 'val'"), label, seed, **gbt)
    return PipelineModel(stages=[*fitted.stages, trees]), cols, curve


def prepare(df: DataFrame, key: str, label: str, onehot: list[str] | None = None,
            columns: list[str] | None = None) -> tuple[PipelineModel, DataFrame, list[str]]:
    """(fitted preprocessing, ``train`` and ``val`` rows with their feature
    vectors, the columns read)."""
    num, hot = supported_columns(df)
    num, hot = columns if columns is not None else num, onehot if onehot is not None else hot
    num = [c for c in num if c not in hot]
    cols = num + hot
    data = coerce_numeric(df.select(key, label, "split", *cols), cols).withColumn(label, F.col(label).cast("double"))
    fitted = preprocessing(num, hot).fit(data.where("split = 'train'"))
    ready = fitted.transform(data.where("split != 'test'"))
    # dense, as trees look values up by slot; the slots' types are kept
    dense = array_to_vector(vector_to_array("features")).alias("features", metadata=ready.schema["features"].metadata)
    ready = cut(ready.select("split", label, dense))
    return fitted, ready, cols


def train(df: DataFrame, key: str, label: str, seed: int = 42, **gbt) -> tuple[PipelineModel, list[str]]:
    return train_stopped(df, key, label, seed, **gbt)[:2]


def score(model: PipelineModel, df: DataFrame, cols, label: str) -> DataFrame:
    data = coerce_numeric(df, cols)
    if label in df.columns:
        data = data.withColumn(label, F.col(label).cast("double"))
    out = model.transform(data)
    return out.withColumn("score", vector_to_array("probability").getItem(1))


def classification_metrics(scored: DataFrame, label: str, score: str, prediction: str, by: str) -> DataFrame:
    """One row per ``by`` value: n, accuracy, and precision, recall and f1 of
    label 1, log_loss, and the exact areas roc_auc and pr_auc.

    One grouped pass gives the counts and the loss; the areas are sums over
    the distinct scores with their running counts."""
    y, p = F.col(label).cast("long"), F.col(prediction).cast("long")
    sure = F.greatest(F.least(F.col(score), F.lit(1 - 1e-15)), F.lit(1e-15))
    loss = -F.when(y == 1, F.log(sure)).otherwise(F.log(1 - sure))

    def count(cond: Column) -> Column:
        return F.sum(cond.cast("long"))

    flat = scored.groupBy(by).agg(
        F.count(F.lit(1)).alias("n"), count(y == p).alias("_right"), count((y == 1) & (p == 1)).alias("_tp"),
        count(p == 1).alias("_said"), count(y == 1).alias("_are"), F.avg(loss).alias("log_loss"))
    cum = _cumulative(scored, label, score, by)
    tp, fp, tp0, fp0 = F.col("tp"), F.col("fp"), F.col("tp") - F.col("pos"), F.col("fp") - F.col("neg")
    precision = tp / (tp + fp)
    before = F.when(tp0 + fp0 > 0, tp0 / (tp0 + fp0)).otherwise(precision)
    areas = cum.groupBy(by).agg(
        F.try_divide(F.sum(F.col("neg") * (tp + tp0)), 2 * F.max("P") * F.max("N")).alias("roc_auc"),
        F.try_divide(F.sum(F.col("pos") * (precision + before)), 2 * F.max("P")).alias("pr_auc"))
    said, are, hit = F.col("_said"), F.col("_are"), F.col("_tp")
    rates = flat.select(
        F.col(by).alias("_by"), "n", (F.col("_right") / F.col("n")).alias("accuracy"),
        F.coalesce(F.try_divide(hit, said), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide(hit, are), F.lit(0.0)).alias("recall"),
        F.coalesce(F.try_divide(2 * hit, said + are), F.lit(0.0)).alias("f1"), "log_loss")
    return rates.join(areas, rates["_by"].eqNullSafe(areas[by])).drop("_by")


def metrics(scored: DataFrame, label: str) -> DataFrame:
    """(split, metric, value) for train / val / test."""
    wide = classification_metrics(scored, label, "score", "prediction", "split")
    names = ["accuracy", "precision", "recall", "f1", "log_loss", "roc_auc", "pr_auc"]
    return wide.unpivot("split", names, "metric", "value")


def confusion_matrix(scored: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    return scored.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"))


def _cumulative(df: DataFrame, label: str, score: str, by: str | None = None) -> DataFrame:
    """(threshold, pos, neg, tp, fp, P, N) of every distinct score (of each
    ``by`` value): positives and negatives at it, and those at it or above.

    Sums run inside score ranges; what the higher ranges hold is added from a
    table of one row per range and group.  No window spans the table."""
    y = F.col(label).cast("long")
    group = F.col(by) if by else F.lit(0)
    at = df.groupBy(group.alias("_g"), F.col(score).alias("threshold")).agg(
        F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"))
    at = cut(at.repartitionByRange("_g", F.desc("threshold")).withColumn("_r", F.spark_partition_id()))
    ranges = at.groupBy("_g", "_r").agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    every = Window.partitionBy("_g")
    before = every.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    heads = ranges.select(
        F.col("_g").alias("_hg"), F.col("_r").alias("_hr"),
        F.coalesce(F.sum("_p").over(before), F.lit(0)).alias("_p0"), F.sum("_p").over(every).alias("P"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"), F.sum("_n").over(every).alias("N"))
    upto = Window.partitionBy("_g", "_r").orderBy(F.desc("threshold")).rowsBetween(Window.unboundedPreceding, 0)
    return at.join(heads, (at["_r"] == heads["_hr"]) & at["_g"].eqNullSafe(heads["_hg"])).select(
        *([F.col("_g").alias(by)] if by else []),
        "threshold", "pos", "neg", (F.col("_p0") + F.sum("pos").over(upto)).alias("tp"),
        (F.col("_n0") + F.sum("neg").over(upto)).alias("fp"), "P", "N")


def roc_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score."""
    return _cumulative(df, label, score).select(
        "threshold", (F.col("fp") / F.col("N")).alias("fpr"), (F.col("tp") / F.col("P")).alias("tpr"))


def pr_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """(threshold, recall, precision) at every distinct score."""
    return _cumulative(df, label, score).select(
        "threshold", (F.col("tp") / F.col("P")).alias("recall"),
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"))


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Exact area under the ROC curve: of all pairs of a positive and a
    negative row, the share that the score orders rightly, ties by half."""
    # twice the ordered pairs, summed as integers
    twice = F.sum(F.col("neg") * (2 * F.col("tp") - F.col("pos")))
    return _cumulative(df, label, score).agg((twice / (2 * F.max("P") * F.max("N"))).alias("auc"))


def permute_column(df: DataFrame, col: str, key: str, seed: int = 7, group_rows: int = 1000) -> DataFrame:
    """``col`` shuffled across rows: rows go to random groups of about
    ``group_rows`` and the values rotate by one place inside each group (a
    window over a bounded group, never over the whole table)."""
    n = df.count()
    groups = max(1, n // group_rows)
    g = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(groups))
    o = F.xxhash64(F.col(key), F.lit(seed + 1))
    t = df.withColumn("_g", g).withColumn("_o", o)
    w = Window.partitionBy("_g").orderBy("_o", key)
    wall = Window.partitionBy("_g").orderBy("_o", key).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    moved = F.when(F.row_number().over(w) == 1, F.last(col).over(wall)).otherwise(F.lag(col).over(w))
    return t.withColumn(col, moved).drop("_g", "_o")


def read_trees(model: GBTClassificationModel) -> list[tuple[float, tuple | float]]:
    """(weight, root) of every tree, as its description has it: a leaf is its
    prediction, an inner node (slot, threshold or list of the values that go
    left, left node, right node)."""
    lines = iter(model.toDebugString.splitlines()[1:])

    def node() -> tuple | float:
        line = next(lines).strip()
        if line.startswith("Predict: "):
            return float(line.removeprefix("Predict: "))
        slot, most, values = re.fullmatch(r"If \(feature (\d+) (?:<= (\S+)|in \{(\S*)\})\)", line).groups()
        left = node()
        next(lines)  # Else
        return int(slot), float(most) if most else [float(x) for x in values.split(",")], left, node()

    return [(float(re.fullmatch(r"\s*Tree \d+ \(weight (\S+)\):", line)[1]), node()) for line in lines]


def swapped_scores(trees: list[tuple[float, tuple | float]], column_of: list[int], copies: int, label: str,
                   rows: int = 4096):
    """Arrow step from (``label``, ``_own``, ``_other``), two feature vectors
    a row, to (feature, ``label``, score): feature 0 is the row's score, each
    further one up to ``copies`` - 1 its score with the slots of that column
    (``column_of`` a slot) taken from ``_other``.

    A tree is walked once for all copies: below a node, only the columns that
    are asked there can tell a copy from the row itself."""

    def left(test, x):
        return x <= test if isinstance(test, float) else np.isin(x, test)

    def walk(node, own, other):
        """(prediction of the row, predictions of the copies that may differ)"""
        if isinstance(node, float):
            return node, {}
        slot, test, a, b = node
        (yes, yes_of), (no, no_of), mine = walk(a, own, other), walk(b, own, other), column_of[slot]
        goes = left(test, own[slot])
        moved = {c: np.where(goes, yes_of.get(c, yes), no_of.get(c, no)) for c in {*yes_of, *no_of} - {mine}}
        moved[mine] = np.where(left(test, other[slot]), yes_of.get(mine, yes), no_of.get(mine, no))
        return np.where(goes, yes, no), moved

    def slots(column):
        return np.ascontiguousarray(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).T)

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, rows):
                batch = whole.slice(at, rows)
                own, other = slots(batch.column("_own")), slots(batch.column("_other"))
                # every copy sums all trees in the same order: rows that end in the same leaves are tied
                sums = np.zeros((copies, batch.num_rows))
                for weight, root in trees:
                    value, moved = walk(root, own, other)
                    for c in range(copies):
                        sums[c] += weight * moved.get(c, value)
                with np.errstate(over="ignore"):
                    scores = 1.0 - 1.0 / (1.0 + np.exp(2.0 * sums))
                for c in range(copies):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(batch.num_rows, c, "int32")), batch.column(label), pa.array(scores[c])],
                        names=["feature", label, "score"])

    return run


def permutation_importance(model: PipelineModel, df: DataFrame, cols, key: str, label: str,
                           split: str = "test", seed: int = 7, group_rows: int = 1000) -> DataFrame:
    """(feature, importance) = AUC drop when the feature is permuted.

    All features are permuted in one pass (each row looks at one other row of
    its group of about ``group_rows``) and scored in one job: the feature
    vectors are made once a row, and a permuted feature is one whose slots
    come from the other row's vector."""
    part = df.where(F.col("split") == split).select(key, label, *cols)
    groups = max(1, part.count() // group_rows)
    # only the vectors are read of the scored rows, so the trees run in the step below alone
    spread = score(model, part, cols, label).select(
        key, label, vector_to_array("features").alias("_own"),
        F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(groups)).alias("_g"),
        F.xxhash64(F.col(key), F.lit(seed + 1)).alias("_o"))
    in_group = Window.partitionBy("_g").orderBy("_o", key)
    other = F.coalesce(F.lag("_own").over(in_group), F.last("_own").over(
        in_group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    pairs = spread.withColumn("_other", other).select(label, "_own", "_other")
    names = ["", *cols]
    column_of = [names.index(c) for c, _ in slot_columns(model, coerce_numeric(df, cols), model.stages[0].getInputCols())]
    step = swapped_scores(read_trees(model.stages[-1]), column_of, len(names), label)
    schema = StructType([StructField("feature", IntegerType()), pairs.schema[label], StructField("score", DoubleType())])
    cum = _cumulative(pairs.mapInArrow(step, schema), label, "score", "feature")
    ordered = F.sum(F.col("neg") * (2 * F.col("tp") - F.col("pos")))
    auc = cum.groupBy("feature").agg(F.try_divide(ordered, 2 * F.max("P") * F.max("N")).alias("auc"))
    base = auc.where("feature = 0").select(F.col("auc").alias("_base"), F.lit(True).alias("_all"))
    # one row joined to one row per feature
    return auc.where("feature > 0").withColumn("_all", F.lit(True)).join(base, "_all").select(
        F.get(F.array(*[F.lit(c) for c in names]), "feature").alias("feature"),
        (F.col("_base") - F.col("auc")).alias("importance"))


def slot_columns(model: PipelineModel, df: DataFrame, num: list[str]) -> list[tuple[str, str]]:
    """(column, value or "") of every slot of the feature vector, from the
    metadata that the stages leave in it; one-hot columns have values."""
    attrs = PipelineModel(stages=model.stages[:-1]).transform(df.limit(0)).schema["features"].metadata["ml_attr"]["attrs"]
    slots = sorted((a["idx"], a["name"]) for kind in attrs.values() for a in kind)
    names = []
    for _, name in slots:
        column, _, value = name.partition("__ohe_")
        names.append((column, value) if value else (num[int(name.removeprefix("num_scaled_"))], ""))
    return names


def slot_names(model: PipelineModel, df: DataFrame, num: list[str]) -> list[str]:
    """A name for every slot: a column, or ``column=value`` of a one-hot column."""
    return [f"{column}={value}" if value else column for column, value in slot_columns(model, df, num)]


def feature_importances(spark, model: PipelineModel, cols, df: DataFrame) -> DataFrame:
    """The trees' split-gain importances by slot (a quick view)."""
    names = slot_names(model, coerce_numeric(df, cols), model.stages[0].getInputCols())
    imp = model.stages[-1].featureImportances.toArray().tolist()
    return spark.createDataFrame(list(zip(names, [float(x) for x in imp], strict=True)),
                                 "feature string, importance double")


def shapley_values(score_rows: Callable[[DataFrame], DataFrame], examples: DataFrame, background: DataFrame,
                   cols: list[str], key: str, seed: int = 7) -> DataFrame:
    """(key, feature, contribution, base): how much each feature of an example
    adds to its score over ``base``, the mean score of the background rows.

    Sampled Shapley values.  Every example meets every background row with a
    seeded order of the features; features change from the background's value
    to the example's one by one in that order, and the change of the score is
    the feature's.  The changes of a pair add up to the difference of its two
    scores, so an example's contributions add up to its score minus ``base``.
    All steps are rows of one scoring job: examples x background x (features
    + 1) rows, so both tables are samples of a size that the caller sets.
    ``score_rows`` adds a column ``score`` to a frame of ``cols``.
    """
    d = len(cols)
    n = background.count()
    behind = numbered(background.select(F.struct(*cols).alias("_b"), F.xxhash64(key).alias("_h")),
                      [F.col("_h")], "_j").select("_b", F.col("_j").cast("int").alias("_j"))
    pairs = (examples.select(F.col(key).alias("_key"), F.struct(*cols).alias("_x"))
             .withColumn("_j", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).join(behind, "_j"))
    order = F.array_sort(F.array(*[
        F.struct(F.xxhash64(F.col("_key"), F.col("_j"), F.lit(seed), F.lit(i)).alias("h"), F.lit(i).alias("i"))
        for i in range(d)]))
    steps = (pairs.withColumn("_order", F.transform(order, lambda o: o["i"]))
             .withColumn("_step", F.explode(F.sequence(F.lit(0), F.lit(d)))))
    mixed = steps.select("_key", "_j", "_step", F.get("_order", F.col("_step") - 1).alias("_f"), *[
        F.when(F.array_position("_order", F.lit(i)) <= F.col("_step"), F.col("_x")[c]).otherwise(F.col("_b")[c]).alias(c)
        for i, c in enumerate(cols)])
    scored = score_rows(mixed).select("_key", "_j", "_step", "_f", "score")
    along = Window.partitionBy("_key", "_j").orderBy("_step")  # features + 1 rows
    moved = scored.withColumn("_gain", F.col("score") - F.lag("score").over(along)).withColumn(
        "_start", F.min_by("score", "_step").over(Window.partitionBy("_key", "_j")))
    names = F.array(*[F.lit(c) for c in cols])
    return moved.where("_step > 0").groupBy("_key", "_f").agg(
        F.avg("_gain").alias("contribution"), F.avg("_start").alias("base")).select(
        F.col("_key").alias(key), F.get(names, F.col("_f")).alias("feature"), "contribution", "base")


def search(df: DataFrame, key: str, label: str, grid: dict | None = None, seed: int = 42,
           parallelism: int | None = None, **gbt):
    """Model search over a fixed grid: every candidate trains on the ``train``
    rows, stops by and is scored by ROC AUC on the ``val`` rows.  The rows are
    prepared once for all candidates, which train in parallel Spark jobs (all
    at once unless ``parallelism`` is given: trees on a scaled table are many
    short jobs); returns (best PipelineModel, feature columns, table of
    (params, auc) rows)."""
    grid = grid or {"maxDepth": [3, 5], "stepSize": [0.0321, 0.1]}
    candidates = [dict(zip(grid, values, strict=True)) for values in product(*grid.values())]
    num, hot = supported_columns(df)
    if not num:  # a table without the supported columns: all of its numbers
        num = [c for c, t in df.dtypes if c not in {key, label, "split"} and t.split("(")[0] in NUMBER_TYPES]
    fitted, ready, cols = prepare(df, key, label, hot, num)
    train_rows, val_rows = ready.where("split = 'train'"), ready.where("split = 'val'")

    def run(params: dict):
        trees, _ = fit_stopped(train_rows, val_rows, label, seed, **{**gbt, **params})
        val = trees.transform(val_rows).withColumn("score", vector_to_array("probability").getItem(1))
        return float(roc_auc(val, label, "score").first()[0] or 0.0), PipelineModel(stages=[*fitted.stages, trees])

    with ThreadPoolExecutor(parallelism or len(candidates)) as pool:
        done = list(pool.map(run, candidates))
    best = max(range(len(done)), key=lambda i: done[i][0])
    rows = [(str(c), auc) for c, (auc, _) in zip(candidates, done, strict=True)]
    table = df.sparkSession.createDataFrame(rows, "params string, auc double")
    return done[best][1], cols, table

"""Toxicity by weak supervision: many voters, a generative label model over
their votes, and a linear classifier trained on its posteriors.

Voters say toxic, clean or nothing of a text.  Some are word lists written
here, one for each of four languages; more are lexicons mined from a bounded
sample of labelled texts (words and word beginnings that toxic texts have and
others lack); the rest are patterns (masked words, shouting, shares of mined
words).  The label model holds for each voter the chances of its three answers
in toxic and in clean texts and the correlations of voters within a class; a
voter that goes along with others counts less.  It is estimated by
expectation-maximisation over the votes on all documents, held to the
frequencies in the labelled sample.  Its posteriors for the sample, joined
with the label as one more fallible voter, are the targets of a logistic
regression on shares of the mined words and beginnings, each and together.

Scale: the sample is bounded (``Fit``); all documents are read once for votes
and features, which are stored (some 100 bytes a document), and the rounds of
the label model run over counts of equal votes.  No text is shuffled, no row
but the sample's features and sums of fixed size reach the driver.

Defined results: null and empty texts have no votes and score as the
classifier's constant; without labelled texts of both classes every score is
0; repeated rows get equal scores; empty tables give no rows; further columns
are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weft.llm.common import stored
from weft.llm.words import table_chunks

LEXICONS = (
    "idiot moron stupid dumb imbecile trash garbage scum loser clown pathetic worthless disgusting filth vermin "
    "bastard creep jerk freak hate hateful ugly coward liar scumbag dirtbag",
    "idiot dumm blöd dreck abschaum versager trottel depp arschloch widerlich wertlos ekelhaft hässlich feigling "
    "lügner schwein hasse mistkerl",
    "idiot idiote imbécile stupide ordure racaille minable pathétique dégoûtant crétin débile salaud connard lâche "
    "menteur déteste nul",
    "idiota imbécil estúpido estúpida basura escoria perdedor payaso patético asqueroso inútil tonto cobarde "
    "mentiroso odio feo cabrón",
)
BEGINNINGS = range(3, 8)  # letters of a word's beginning that can be a feature
LETTERLESS = r"[^\p{L}]+"
MASKED = r"\p{L}[*@#$%&]+\p{L}"
LOUD = r"^[^\p{L}]*\p{Lu}{4,}[^\p{L}]*$"
CRY = r"[!?]{3,}$"
NO, CLEAN, TOXIC = 0, 1, 2


@dataclass(frozen=True)
class Fit:
    """Bounds of the labelled sample and sizes of the model."""

    toxic_texts: int = 1500
    other_texts: int = 3000
    candidates: int = 20_000  # words and beginnings looked at
    features: int = 1500
    lexicons: int = 12
    lexicon_size: int = 20
    rounds: int = 8
    steps: int = 300


@dataclass
class Tokens:
    """Words of some texts: token k is word ``codes[k]`` of text ``row[k]``."""

    size: np.ndarray
    row: np.ndarray
    codes: np.ndarray
    raw: pa.Array
    words: pa.Array


def tokens_of(text: pa.Array) -> Tokens:
    lists = pc.ascii_split_whitespace(pc.fill_null(text.cast(pa.large_string()), ""))
    found = lists.values.dictionary_encode()
    raw = found.dictionary
    words = pc.utf8_lower(pc.replace_substring_regex(raw, LETTERLESS, ""))
    offsets = np.asarray(lists.offsets, np.int64)
    codes = np.asarray(found.indices, np.int64)
    row = np.repeat(np.arange(len(text)), np.diff(offsets))
    blank = np.asarray(pc.equal(pc.binary_length(raw), 0)).astype(bool)
    if blank.any():  # at the ends of a text
        keep = ~blank[codes]
        codes, row = codes[keep], row[keep]
    return Tokens(np.bincount(row, minlength=len(text)), row, codes, raw, words)


def units_of(words: pa.Array) -> list[pa.Array]:
    """Per kind of unit its text for each word, null where it has none: the
    beginnings of each length, and the whole word with a mark behind it."""
    size = pc.utf8_length(words)
    out = [pc.if_else(pc.greater_equal(size, k), pc.utf8_slice_codeunits(words, 0, k), pa.scalar(None, words.type))
           for k in BEGINNINGS]
    whole = pc.binary_join_element_wise(words, pa.scalar("$", words.type), pa.scalar("", words.type))
    return [*out, pc.if_else(pc.greater(size, 1), whole, pa.scalar(None, words.type))]


def unit_counts(t: Tokens, known: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, index in ``known``, count) of the known units of each text."""
    pairs = []
    for unit in units_of(t.words):
        at = np.asarray(pc.fill_null(pc.index_in(unit, value_set=known), -1), np.int64)
        at = at[t.codes]
        hit = at >= 0
        pairs.append(t.row[hit] * len(known) + at[hit])
    key, count = np.unique(np.concatenate(pairs), return_counts=True)
    return key // max(1, len(known)), key % max(1, len(known)), count


def weight(count: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A feature's value: more for a larger share of a text's words."""
    return np.minimum(1.0, 0.4 + 60.0 * count / np.maximum(1, size))


class Voters:
    """The voters: lists, mined lexicons, patterns."""

    def __init__(self, known: list[str], lexicon_of: np.ndarray, lexicons: int):
        self.known = pa.array(known, pa.large_string())
        self.lexicon_of, self.lexicons = lexicon_of, lexicons  # per unit its lexicon or -1
        self.lists = [pa.array(x.split(), pa.large_string()) for x in LEXICONS]
        self.count = len(self.lists) + lexicons + 5

    def _rows_with(self, t: Tokens, words: np.ndarray) -> np.ndarray:
        return np.bincount(t.row[words[t.codes]], minlength=len(t.size))

    def read(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Votes (texts, voters), and (row, unit, value) of the features."""
        t = tokens_of(text)
        row, unit, count = unit_counts(t, self.known)
        n, long_enough = len(t.size), t.size >= 5
        votes = np.zeros((n, self.count), np.int8)

        def told(hits: np.ndarray, k: int) -> None:
            votes[:, k] = np.where(hits > 0, TOXIC, np.where(long_enough, CLEAN, NO))

        for k, words in enumerate(self.lists):
            told(self._rows_with(t, np.asarray(pc.is_in(t.words, value_set=words)).astype(bool)), k)
        k = len(self.lists)
        lexicon = self.lexicon_of[unit] if len(unit) else unit
        mined = lexicon >= 0
        for x in range(self.lexicons):
            told(np.bincount(row[lexicon == x], minlength=n), k + x)
        k += self.lexicons
        # a word can begin with several units, so this share can pass 1
        share = np.bincount(row[mined], weights=count[mined], minlength=n) / np.maximum(1, t.size)
        votes[:, k] = np.where(share >= 0.01, TOXIC, np.where((share == 0) & long_enough, CLEAN, NO))
        votes[:, k + 1] = np.where(share >= 0.05, TOXIC, NO)
        for i, pattern in enumerate((MASKED, LOUD, CRY)):
            hits = self._rows_with(t, np.asarray(pc.match_substring_regex(t.raw, pattern)).astype(bool))
            votes[:, k + 2 + i] = np.where(hits > np.maximum(0, 0.02 * t.size), TOXIC, NO)
        # one more feature: all mined words of the text together
        some = np.flatnonzero(share > 0)
        value = np.concatenate([weight(count, t.size[row]), np.minimum(1.0, 0.6 + 20.0 * share[some])])
        row, unit = np.concatenate([row, some]), np.concatenate([unit, np.full(len(some), len(self.known))])
        order = np.argsort(row, kind="stable")
        return votes, row[order], unit[order], value[order]


class LabelModel:
    """Chances of each voter's answers by class, and how much it counts."""

    def __init__(self, prior: float, chance: np.ndarray, worth: np.ndarray):
        self.prior, self.chance, self.worth = prior, chance, worth  # chance: (voter, class, answer)

    def logit(self, votes: np.ndarray) -> np.ndarray:
        log = np.log(self.chance[:, 1] / self.chance[:, 0]) * self.worth[:, None]
        return np.log(self.prior / (1 - self.prior)) + log[np.arange(votes.shape[1]), votes].sum(axis=1)

    @staticmethod
    def sums(votes: np.ndarray, toxic: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Per class the products of answers, summed: (2, 3 V + 1, 3 V + 1)."""
        n, v = votes.shape
        one = np.zeros((n, 3 * v + 1))
        one[np.arange(n)[:, None], 3 * np.arange(v) + votes] = 1
        one[:, -1] = 1
        return np.stack([(one * (rows * p)[:, None]).T @ one for p in (1 - toxic, toxic)])

    @classmethod
    def of(cls, sums: np.ndarray, labelled: np.ndarray) -> LabelModel:
        """From expected sums over all rows, held to the labelled ones: the
        mean of both frequencies."""
        v = (sums.shape[1] - 1) // 3
        chance = np.empty((v, 2, 3))
        worth = np.zeros(v)
        for y in (0, 1):
            share = [(s[y][-1, :-1].reshape(v, 3) + 0.5) / (s[y][-1, -1] + 1.5) for s in (sums, labelled)]
            chance[:, y] = (share[0] + share[1]) / 2
            # correlations of toxic votes within the class
            total = max(1e-9, labelled[y][-1, -1])
            mean = labelled[y][-1, TOXIC:-1:3] / total
            both = labelled[y][TOXIC:-1:3, TOXIC:-1:3] / total - mean[:, None] * mean[None, :]
            spread = np.sqrt(np.maximum(np.diag(both), 1e-6))
            along = np.clip(both / (spread[:, None] * spread[None, :]), 0, 1)
            np.fill_diagonal(along, 0)
            worth += 0.5 / (1 + along.sum(axis=1))
        prior = (sums[1][-1, -1] + 1) / (sums[0][-1, -1] + sums[1][-1, -1] + 2)
        return cls(prior, chance, worth)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Model:
    voters: Voters
    label_model: LabelModel
    weights: np.ndarray  # of the features; the constant last


def labelled_sample(docs: DataFrame, labels: DataFrame, learn: Column, fit: Fit) -> DataFrame:
    """(text, toxic) of at most about ``fit`` labelled documents of each class
    where ``learn`` (an expression on doc_id) holds."""
    marks = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic").where(learn & F.col("toxic").isNotNull())
             .groupBy("doc_id").agg(F.max((F.col("toxic") == 1).cast("int")).alias("is_toxic")))
    many = {r.is_toxic: r["count"] for r in marks.groupBy("is_toxic").count().collect()}
    bound = {1: fit.toxic_texts, 0: fit.other_texts}
    pick = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    chosen = [marks.where((F.col("is_toxic") == y) & (pick < int(min(1.0, bound[y] / n) * (1 << 30)) + 1))
              .limit(2 * bound[y]) for y, n in sorted(many.items())]
    if not chosen:
        return None
    ids = chosen[0] if len(chosen) == 1 else chosen[0].unionByName(chosen[1])
    ids = ids.select(F.col("doc_id").alias("_id"), "is_toxic")
    texts = docs.select(F.col("doc_id").cast("long").alias("_key"), F.col("text")).where("text is not null")
    # at most twice the bounds: broadcast; repeated ids are cut by the same bound
    found = texts.join(F.broadcast(ids), texts["_key"] == ids["_id"]).select("text", F.col("is_toxic").alias("toxic"))
    return found.limit(2 * (fit.toxic_texts + fit.other_texts))


def candidate_units(sample: DataFrame, fit: Fit) -> list[str]:
    """The units that most toxic texts of the sample have, in order."""

    def units(batches):
        for t in table_chunks(batches):
            tokens = tokens_of(t.column("text").combine_chunks())
            for unit in units_of(tokens.words):
                u = unit.dictionary_encode()
                code = np.asarray(pc.fill_null(u.indices, -1), np.int64)[tokens.codes]
                hit = code >= 0
                key = np.unique(tokens.row[hit] * (len(u.dictionary) + 1) + code[hit])
                n = np.bincount(key % (len(u.dictionary) + 1), minlength=len(u.dictionary))
                yield pa.RecordBatch.from_arrays([u.dictionary.cast(pa.string()), pa.array(n, pa.int64())],
                                                 names=["unit", "n"])

    toxic = sample.where("toxic = 1").select("text")
    n = F.sum("n")
    rows = (toxic.mapInArrow(units, "unit string, n long").groupBy("unit").agg(n.alias("n")).where("n > 1")
            .orderBy(F.desc("n"), "unit").limit(fit.candidates).collect())
    return sorted(r.unit for r in rows)


def chosen_units(sample: DataFrame, candidates: list[str], fit: Fit) -> tuple[list[str], np.ndarray]:
    """The units that best tell toxic texts, best first, and the lexicon of
    each (-1: none)."""
    known = pa.array(candidates, pa.large_string())

    def counts(batches):
        for t in table_chunks(batches):
            row, unit, _ = unit_counts(tokens_of(t.column("text").combine_chunks()), known)
            y = np.asarray(t.column("toxic"))[row] if len(row) else row
            both = np.bincount(unit * 2 + y, minlength=2 * len(known)).reshape(-1, 2)
            at = np.flatnonzero(both.any(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(both[at, 0]), pa.array(both[at, 1])],
                                             names=["unit", "other", "toxic"])

    texts = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    rows = (sample.select("text", F.col("toxic").cast("long").alias("toxic"))
            .mapInArrow(counts, "unit long, other long, toxic long").groupBy("unit")
            .agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic")).collect())
    toxic, other = np.zeros(len(candidates)), np.zeros(len(candidates))
    for r in rows:
        toxic[r.unit], other[r.unit] = r.toxic, r.other
    rate = [(toxic + 0.5) / (texts[1] + 1), (other + 0.5) / (texts[0] + 1)]
    odds = np.log(rate[0]) - np.log(rate[1])
    # how surely the unit tells: log odds times the root of its toxic texts
    gain = np.where(odds > 1.0, odds * np.sqrt(toxic), 0)
    best = np.argsort(-gain, kind="stable")[:fit.features]
    best = best[gain[best] > 0]
    sure = (odds[best] > 2.5) & (other[best] <= 0.002 * texts[0])
    lexicon = np.full(len(best), -1, np.int64)
    lead = np.flatnonzero(sure)[:fit.lexicons * fit.lexicon_size]
    lexicon[lead] = np.arange(len(lead)) % fit.lexicons  # dealt out, so that each has some of the best
    return [candidates[i] for i in best], lexicon


def read_all(docs: DataFrame, voters: Voters, keep: dict[str, Column]) -> DataFrame:
    """Columns ``keep`` of all documents with votes, units and values."""
    kinds = docs.select(*[c.alias(k) for k, c in keep.items()]).schema
    names = list(keep)
    rows = docs.select("text", *[c.alias(f"_{i}") for i, c in enumerate(keep.values())])
    schema = T.StructType([*[T.StructField(f"_{i}", kinds[k].dataType) for i, k in enumerate(names)],
                           T.StructField("votes", T.BinaryType()), T.StructField("units", T.BinaryType()),
                           T.StructField("shares", T.BinaryType())])

    def read(batches):
        for t in table_chunks(batches, chunk_bytes=4 << 20):
            votes, row, unit, value = voters.read(t.column("text").combine_chunks())
            ends = np.searchsorted(row, np.arange(t.num_rows + 1))
            ids, shares = unit.astype(np.uint16), np.rint(value * 255).astype(np.uint8)
            spans = list(zip(ends[:-1], ends[1:], strict=True))
            t = t.drop_columns(["text"])
            t = t.append_column("votes", pa.array([v.tobytes() for v in votes], pa.binary()))
            t = t.append_column("units", pa.array([ids[a:b].tobytes() for a, b in spans], pa.binary()))
            t = t.append_column("shares", pa.array([shares[a:b].tobytes() for a, b in spans], pa.binary()))
            yield from t.to_batches(20_000)

    return rows.mapInArrow(read, schema)


def votes_in(batch: pa.RecordBatch, voters: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("votes").to_pylist()), np.int8).reshape(batch.num_rows, voters)


def learn_label_model(votes: DataFrame, sample_votes: np.ndarray, labels: np.ndarray, fit: Fit) -> LabelModel:
    """Expectation-maximisation over (votes, n), the votes of all documents."""
    labelled = LabelModel.sums(sample_votes, labels.astype(float), np.ones(len(labels)))
    total = votes.agg(F.sum("n")).first()[0] or 0
    # of all rows as many as in the sample, so that none outweighs the other
    model = LabelModel.of(labelled, labelled)
    voters = sample_votes.shape[1]
    width = 3 * voters + 1
    for _ in range(fit.rounds):
        current = model

        def expected(batches):
            out = np.zeros((2, width, width))
            for b in batches:
                seen = votes_in(b, voters)
                out += LabelModel.sums(seen, sigmoid(current.logit(seen)), np.asarray(b.column("n"), float))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(out.size)), pa.array(out.reshape(-1))],
                                             names=["cell", "value"])

        cells = votes.mapInArrow(expected, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value"))
        sums = np.zeros(2 * width * width)
        for r in cells.collect():
            sums[r.cell] = r.value
        model = LabelModel.of(sums.reshape(2, width, width) / max(1, total) * len(labels), labelled)
    return model


def train(x: np.ndarray, target: np.ndarray, steps: int) -> np.ndarray:
    """Logistic regression with a small penalty, by accelerated gradients."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    w, look = np.zeros(x.shape[1]), np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], 1e-4)
    penalty[-1] = 0
    rate = 4 / (np.mean((x * x).sum(axis=1)) + 1e-3)
    for k in range(steps):
        grad = x.T @ (sigmoid(x @ look) - target) / len(x) + penalty * look
        step = look - rate * grad
        look = step + k / (k + 3) * (step - w)
        w = step
    return w


def fit_model(docs: DataFrame, labels: DataFrame, learn: Column, keep: dict[str, Column],
              fit: Fit = Fit()) -> tuple[Model | None, DataFrame | None]:
    """The model, and the read documents (``read_all``) to be scored."""
    sample = labelled_sample(docs, labels, learn, fit)
    if sample is not None:
        sample = stored(sample, "toxic-sample")
    if sample is None or sample.select("toxic").distinct().count() < 2:
        return None, None
    units, lexicon = chosen_units(sample, candidate_units(sample, fit), fit)
    voters = Voters(units, lexicon, fit.lexicons)
    rows = read_all(sample, voters, {"toxic": F.col("toxic")}).collect()  # bounded by Fit
    rows.sort(key=lambda r: (r._0, bytes(r.votes), bytes(r.units), bytes(r.shares)))
    y = np.array([r._0 for r in rows])
    votes = np.frombuffer(b"".join(bytes(r.votes) for r in rows), np.int8).reshape(len(rows), -1)

    seen = stored(read_all(docs, voters, keep), "toxic-votes")
    patterns = stored(seen.groupBy("votes").agg(F.count(F.lit(1)).alias("n")), "toxic-vote-counts")
    label_model = learn_label_model(patterns, votes, y, fit)

    # the label is one more voter, as right as it agrees with the others
    logit = label_model.logit(votes)
    agree = float(np.clip(np.mean((logit > 0) == (y == 1)), 0.7, 0.99))
    target = sigmoid(np.clip(logit, -4, 4) + np.log(agree / (1 - agree)) * (2 * y - 1))
    x = np.zeros((len(rows), len(units) + 1), np.float32)
    for i, r in enumerate(rows):
        x[i, np.frombuffer(r.units, np.uint16)] = np.frombuffer(r.shares, np.uint8) / np.float32(255)
    return Model(voters, label_model, train(x, target, fit.steps)), seen


def score(docs: DataFrame, labels: DataFrame, learn: Column, keep: dict[str, Column], fit: Fit = Fit()) -> DataFrame:
    """Columns ``keep`` of all documents, ``score`` (0 to 1) of the classifier
    and ``posterior`` of the label model, which learn from the labels of
    documents where ``learn`` holds."""
    model, seen = fit_model(docs, labels, learn, keep, fit)
    if model is None:
        zero = F.lit(0.0)
        return docs.select(*[c.alias(k) for k, c in keep.items()], zero.alias("score"), zero.alias("posterior"))
    weights, label_model = model.weights, model.label_model

    def judge(batches):
        for b in batches:
            units = b.column("units").to_pylist()
            ids = np.frombuffer(b"".join(units), np.uint16)
            shares = np.frombuffer(b"".join(b.column("shares").to_pylist()), np.uint8) / 255.0
            row = np.repeat(np.arange(b.num_rows), [len(u) // 2 for u in units])
            z = np.bincount(row, weights=weights[ids] * shares, minlength=b.num_rows) + weights[-1]
            votes = votes_in(b, len(label_model.chance))
            got = pa.Table.from_batches([b]).drop_columns(["votes", "units", "shares"])
            got = got.append_column("score", pa.array(sigmoid(z)))
            yield from got.append_column("posterior", pa.array(sigmoid(label_model.logit(votes)))).to_batches()

    kinds = [f for f in seen.schema if f.name.startswith("_")]
    schema = T.StructType([*kinds, T.StructField("score", T.DoubleType()), T.StructField("posterior", T.DoubleType())])
    done = seen.mapInArrow(judge, schema)
    return done.select(*[F.col(f"_{i}").alias(k) for i, k in enumerate(keep)], "score", "posterior")

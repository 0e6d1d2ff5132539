"""Language identification by a byte convolutional network.

Bytes are embedded, filters of several widths slide over fixed windows, each
filter's highest answer in the window is kept, and a softmax over these names
the language.  The network is trained in numpy on windows of a bounded sample
of labelled texts (``Training.max_texts`` per language) and broadcast; it has
a few thousand weights.  A text's windows follow each other without gap to
its end; their log probabilities are averaged by their length.

Scale: training sees a bounded sample, prediction is a map over the documents
without a shuffle.

Defined results: null text, or text without any letter, is ``und`` with score
0; without labelled text every document is ``und``; repeated rows get equal
answers; the rest of a last window is filled with spaces.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weft.llm.common import doc_texts
from weft.llm.words import table_chunks

WINDOW = 256
UNKNOWN = "und"
SPACE = 0x20
SLAB = 64  # windows multiplied at once, so the working set stays in cache


@dataclass(frozen=True)
class Training:
    """Sizes of the network and of its bounded training sample."""

    max_texts: int = 1200  # per language
    windows: int = 2  # of each sampled text
    embed: int = 8
    widths: tuple[int, ...] = (2, 3, 4)
    filters: int = 12  # of each width
    epochs: int = 4  # at least, and as many as make ``steps`` batches
    steps: int = 400
    batch: int = 64
    rate: float = 0.01
    seed: int = 5


class ByteNet:
    def __init__(self, langs: list[str], t: Training):
        rng = np.random.default_rng(t.seed)
        self.langs, self.width = langs, max(t.widths)
        d, f = t.embed, t.filters * len(t.widths)
        # filters of lesser width keep zeros behind it
        reach = np.repeat(t.widths, t.filters)
        self.mask = (np.repeat(np.arange(self.width), d)[:, None] < reach[None, :]).astype(np.float32)
        self.p = {
            "embed": rng.normal(0, 0.5, (256, d)).astype(np.float32),
            "w": (rng.normal(0, 0.3, (self.width * d, f)).astype(np.float32) * self.mask),
            "b": np.zeros(f, np.float32),
            "v": rng.normal(0, 0.2, (f, len(langs))).astype(np.float32),
            "c": np.zeros(len(langs), np.float32),
        }

    def _patches(self, x: np.ndarray) -> np.ndarray:
        e = self.p["embed"][x]
        n = x.shape[1] - self.width + 1
        return np.concatenate([e[:, k:k + n] for k in range(self.width)], axis=2)

    def log_probabilities(self, x: np.ndarray) -> np.ndarray:
        """Per window of ``x`` (windows, WINDOW) and language."""
        out = np.empty((len(x), len(self.langs)), np.float32)
        for i in range(0, len(x), SLAB):
            pooled = (self._patches(x[i:i + SLAB]) @ self.p["w"]).max(axis=1)
            z = np.maximum(pooled + self.p["b"], 0) @ self.p["v"] + self.p["c"]
            z -= z.max(axis=1, keepdims=True)
            out[i:i + SLAB] = z - np.log(np.exp(z).sum(axis=1, keepdims=True))
        return out

    def fit(self, x: np.ndarray, y: np.ndarray, t: Training) -> None:
        """Adam on the cross entropy of the windows ``x`` with labels ``y``."""
        rng = np.random.default_rng(t.seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for _ in range(max(t.epochs, -(-t.steps * t.batch // len(x)))):
            order = rng.permutation(len(x))
            for i in range(0, len(x), t.batch):
                step += 1
                grads = self._gradients(x[order[i:i + t.batch]], y[order[i:i + t.batch]])
                for k, g in grads.items():
                    m[k] += 0.1 * (g - m[k])
                    s[k] += 0.001 * (g * g - s[k])
                    self.p[k] -= t.rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.999 ** step)) + 1e-8)

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, rows = self.p, np.arange(len(x))[:, None]
        patches = self._patches(x)
        answers = patches @ p["w"]
        at = answers.argmax(axis=1)  # the pooled place of each filter
        pooled = np.take_along_axis(answers, at[:, None, :], axis=1)[:, 0] + p["b"]
        f = np.maximum(pooled, 0)
        z = f @ p["v"] + p["c"]
        q = np.exp(z - z.max(axis=1, keepdims=True))
        q /= q.sum(axis=1, keepdims=True)
        q[np.arange(len(y)), y] -= 1
        q /= len(y)
        back = (q @ p["v"].T) * (pooled > 0)
        places = patches[rows, at]  # (batch, filter, width * embed)
        g_embed = np.zeros_like(p["embed"])
        to_patch = (back[:, :, None] * p["w"].T[None]).reshape(len(x), at.shape[1], self.width, -1)
        for k in range(self.width):
            np.add.at(g_embed, x[rows, at + k], to_patch[:, :, k])
        return {"embed": g_embed, "w": np.einsum("bf,bfd->df", back, places) * self.mask, "b": back.sum(axis=0),
                "v": f.T @ q, "c": q.sum(axis=0)}

    def predict(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(index of the language, its probability) of each text; texts
        without bytes get index 0."""
        text = text.cast(pa.large_binary())
        offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
        data = np.frombuffer(text.buffers()[2], np.uint8) if offsets[-1] > offsets[0] else np.zeros(1, np.uint8)
        size = np.diff(offsets)
        count = -(-size // WINDOW)
        row = np.repeat(np.arange(len(size)), count)
        start = offsets[:-1][row] + WINDOW * (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count))
        end = offsets[1:][row]
        total = np.zeros((len(size), len(self.langs)))
        for i in range(0, len(row), 4096):
            j = slice(i, i + 4096)
            at = start[j, None] + np.arange(WINDOW)
            x = np.where(at < end[j, None], data[np.minimum(at, len(data) - 1)], SPACE)
            weight = np.minimum(end[j] - start[j], WINDOW)
            np.add.at(total, row[j], self.log_probabilities(x) * weight[:, None])
        total /= np.maximum(size, 1)[:, None]
        q = np.exp(total - total.max(axis=1, keepdims=True))
        q /= q.sum(axis=1, keepdims=True)
        return q.argmax(axis=1), q.max(axis=1)


def windows_of(text: bytes, count: int) -> list[np.ndarray]:
    """``count`` windows at even distances over a text (fewer if it is short)."""
    data = np.frombuffer(text, np.uint8)
    starts = {round(k * max(0, len(data) - WINDOW) / max(1, count - 1)) for k in range(count)}
    return [np.concatenate([w := data[s:s + WINDOW], np.full(WINDOW - len(w), SPACE, np.uint8)]) for s in sorted(starts)]


def train(docs: DataFrame, learn: Column, t: Training = Training()) -> ByteNet | None:
    """A network for the languages of the rows where ``learn`` holds and text
    and lang are known; None where there are no such rows."""
    known = docs.where(learn & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    pick = F.pmod(F.xxhash64("doc_id", "lang"), F.lit(1 << 30))
    counts = docs.where(learn & F.col("lang").isNotNull()).groupBy("lang").count().collect()
    share = {r["lang"]: t.max_texts / r["count"] for r in counts}
    if not share:
        return None
    limit = F.create_map(*[F.lit(x) for k, v in share.items() for x in (k, min(1.0, v) * (1 << 30))])
    sample = (known.where(pick < limit[F.col("lang")]).select("lang", F.col("text").cast("binary").alias("text"))
              .limit(2 * t.max_texts * len(share)))
    # only the windows leave the executors
    rows = sample.mapInArrow(lambda it: _cut_windows(it, t.windows), "lang string, win binary").collect()
    if not rows:
        return None
    rows.sort()
    langs = sorted({r.lang for r in rows})
    net = ByteNet(langs, t)
    x = np.frombuffer(b"".join(bytes(r.win) for r in rows), np.uint8).reshape(-1, WINDOW)
    net.fit(x, np.array([langs.index(r.lang) for r in rows]), t)
    return net


def _cut_windows(batches, count: int):
    for b in batches:
        out = [(lang, w.tobytes()) for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)
               for w in windows_of(text, count)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.binary())],
            names=["lang", "win"])


def with_language(docs: DataFrame, net: ByteNet | None, keep: list[str], lang_pred: str = "lang_pred",
                  score: str = "score") -> DataFrame:
    """Columns ``keep`` of the documents, the language and its score under the
    names given."""
    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select("text", letter.alias("_letter"), *[F.col(c).alias(f"_{i}") for i, c in enumerate(keep)])
    schema = T.StructType(
        [T.StructField(f"_{i}", docs.schema[c].dataType) for i, c in enumerate(keep)]
        + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def predict(batches):
        net = shared.value
        for t in table_chunks(batches, chunk_bytes=4 << 20):
            letter = t.column("_letter").to_numpy()
            lang, score = np.full(t.num_rows, UNKNOWN, object), np.zeros(t.num_rows)
            if net is not None and letter.any():
                text = t.column("text").filter(pa.array(letter)).combine_chunks()
                best, q = net.predict(text)
                lang[letter], score[letter] = np.array(net.langs, object)[best], q
            t = t.drop_columns(["text", "_letter"])
            t = t.append_column("lang_pred", pa.array(lang, pa.string())).append_column("score", pa.array(score))
            yield from t.to_batches()

    out = rows.mapInArrow(predict, schema)
    return out.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(keep)],
                      F.col("lang_pred").alias(lang_pred), F.col("score").alias(score))

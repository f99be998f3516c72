"""Toxicity: averaged subword embeddings under a linear softmax, trained jointly in NumPy."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: ASCII characters that separate words besides white space.
BREAKS = bytes(c for c in range(128) if not chr(c).isalnum())
TO_BLANK = bytes.maketrans(BREAKS, b" " * len(BREAKS))
#: Words whose sums a task keeps at a time.
CACHE = 400_000


def words_of(text: str | None) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").translate(TO_BLANK).split() if text else []


def subwords(word: bytes, buckets: int, shortest: int = 3, longest: int = 5) -> list[int]:
    """Buckets of the marked word and of its character n-grams."""
    s = f"<{word.decode('utf-8', 'replace')}>"
    grams = {s[i:i + n] for n in range(shortest, longest + 1) for i in range(len(s) - n + 1)} | {s}
    return [zlib.crc32(g.encode("utf-8", "surrogatepass")) % buckets for g in grams]


@dataclass
class Model:
    """A text's odds are ``bias`` plus the mean of ``weight`` over its subwords."""

    weight: np.ndarray
    bias: float

    def scorer(self):
        weight, sums = self.weight, {}

        def of(word: bytes) -> tuple[float, int]:
            ids = subwords(word, len(weight))
            if len(sums) >= CACHE:
                sums.clear()
            sums[word] = known = (float(weight[ids].sum()), len(ids))
            return known

        def score(text: str | None) -> float:
            total, n = 0.0, 0
            for w in words_of(text):
                a, k = sums.get(w) or of(w)
                total += a
                n += k
            odds = self.bias + (total / n if n else 0.0)
            return float(1 / (1 + np.exp(-np.clip(odds, -60, 60))))

        return score

    def score(self, text: Column) -> Column:
        """Probability of each text, as a column; null and empty texts have that of the bias."""
        @F.arrow_udf("double")
        def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            score = self.scorer()
            for texts in batches:
                yield pa.array([score(t.as_py()) for t in texts], pa.float64())

        return scored(text)


def fit(texts: list[str], labels: list[int], *, prior: float, buckets: int = 1 << 16, size: int = 8,
        epochs: int = 12, batch: int = 64, rate: float = 0.05, scale: float = 30.0, decay: float = 1e-4,
        seed: int = 7) -> Model:
    """Embeddings of subwords and the softmax over their mean, trained jointly by Adam.

    The two classes weigh the same while training; the bias is then moved to ``prior``, the share
    of label 1, so that scores are probabilities. ``scale`` multiplies the mean, so that the
    few telling words of a long text reach the softmax.
    """
    random, y = np.random.default_rng(seed), np.array(labels)
    known: dict[bytes, list[int]] = {}
    rows = []
    for text in texts:
        counts: dict[int, int] = {}
        for w in words_of(text):
            for b in known.get(w) or known.setdefault(w, subwords(w, buckets)):
                counts[b] = counts.get(b, 0) + 1
        ids = np.fromiter(counts, np.int64, len(counts))
        n = np.fromiter(counts.values(), np.float32, len(counts))
        rows.append((ids, n / max(1.0, float(n.sum()))))
    embed = (random.standard_normal((buckets, size)) / buckets ** 0.5).astype(np.float32)
    soft = (random.standard_normal((size, 2)) * 0.5).astype(np.float32)
    bias = np.zeros(2, np.float32)
    params = [embed, soft, bias]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    weigh = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    step = 0
    for epoch in range(epochs):
        order = random.permutation(len(rows))
        for at in range(0, len(order), batch):
            some = order[at:at + batch]
            ids = np.concatenate([rows[i][0] for i in some])
            share = np.concatenate([rows[i][1] for i in some]) * np.float32(scale)
            doc = np.repeat(np.arange(len(some)), [len(rows[i][0]) for i in some])
            mean = np.zeros((len(some), size), np.float32)
            picked = embed[ids] * share[:, None]
            for k in range(size):
                mean[:, k] = np.bincount(doc, picked[:, k], len(some))
            logits = mean @ soft + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(some)), y[some]] -= 1
            p *= (weigh[some] / len(some))[:, None]
            back = p.astype(np.float32) @ soft.T
            touched, which = np.unique(ids, return_inverse=True)
            g = np.empty((len(touched), size), np.float32)
            for k in range(size):
                g[:, k] = np.bincount(which, share * back[doc, k], len(touched))
            step += 1
            now = rate * (1 - epoch / epochs)
            for j, (where, grad) in enumerate([(touched, g + decay * embed[touched]), (slice(None), mean.T @ p),
                                               (slice(None), p.sum(axis=0))]):
                first[j][where] = m = 0.9 * first[j][where] + 0.1 * grad
                second[j][where] = v = 0.99 * second[j][where] + 0.01 * grad ** 2
                params[j][where] -= now * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    odds = np.log(max(prior, 1e-6) / max(1 - prior, 1e-6))
    return Model(scale * (embed @ (soft[:, 1] - soft[:, 0])), float(bias[1] - bias[0] + odds))


def train(docs: DataFrame, labels: DataFrame, *, text: str = "text", id: str = "doc_id", label: str = "toxic",
          per_class: int = 1500, longest: int = 20_000, seed: int = 7, **how) -> Model:
    """A model from a bounded sample of the labelled rows.

    Each class gives the ``per_class`` rows that come first in a seeded order of ids; a text of
    more than ``longest`` characters is not trained on (it is scored whole all the same). So at
    most ``2 * per_class * longest`` characters reach the driver. The prior counts all labels.
    Labels that are null or have no document are passed over; without both classes every
    text scores the share of label 1.
    """
    given = labels.where(F.col(label).isin(0, 1) & F.col(id).isNotNull()).select(
        F.col(id).alias("_id"), F.col(label).cast("int").alias("_label"))
    share = given.agg(F.avg("_label")).first()[0] or 0.0
    order = F.xxhash64(F.col("_id").cast("string"), F.lit(seed))
    chosen = [r for y in (0, 1) for r in given.where(F.col("_label") == y).distinct()
              .orderBy(order, "_id").limit(per_class).collect()]
    if not chosen:
        return Model(np.zeros(1, np.float32), float(np.log(1e-6)))
    # bounded by 2 * per_class rows
    picked = F.broadcast(docs.sparkSession.createDataFrame(chosen, given.schema))
    sample = (docs.select(F.col(id).alias("_id"), F.col(text).alias("_text")).join(picked, "_id")
              .where(F.length("_text") <= longest).groupBy("_id", "_label").agg(F.min("_text").alias("_text"))
              .collect())
    sample.sort(key=lambda r: r["_id"])
    y = [r["_label"] for r in sample]
    if len(set(y)) < 2:
        return Model(np.zeros(1, np.float32), float(np.log(max(share, 1e-6) / max(1 - share, 1e-6))))
    return fit([r["_text"] for r in sample], y, prior=share, seed=seed, **how)


def held_out(id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(id.cast("string")) % 4 == 2, F.lit(False))


def judge(docs: DataFrame, labels: DataFrame, *, text: str = "text", id: str = "doc_id", label: str = "toxic",
          threshold: float = 0.3, **how) -> DataFrame:
    """``(id, held_out, score, predicted)`` of every document.

    The score sees the text alone. Null and empty texts score the model's bias; repeated rows
    score alike; a null id is not held out and teaches nothing. Other columns are not looked at.
    """
    model = train(docs, labels.where(~held_out(F.col(id))), text=text, id=id, label=label, **how)
    scored = docs.select(F.col(id), held_out(F.col(id)).alias("held_out"), model.score(F.col(text)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))

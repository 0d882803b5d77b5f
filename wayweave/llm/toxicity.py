"""Toxicity by a factorization machine over hashed terms.

A text is the set of its words and of their first five bytes (stems), hashed to 2**18 buckets. Each bucket the machine keeps has a
weight and a short vector; the inner product of two vectors is the weight of the pair, so a word
that is harmless alone and an insult beside another is learned as such.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayweave.llm.bytetext import ALNUM, U64, word_pieces
from wayweave.plans.workspace import Workspace, small_batches

BITS = 18
FACTORS = 4
STEM = 5
#: Squared gradients that weights and vectors of buckets which tell nothing alone begin with, so
#: that chance moves them little; the best of some values by cross-validation on training rows.
DAMP = 10.0, 1e-3


def _terms(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(texts, text number, bucket) of the words and stems of each piece."""
    for (i, j, h, at), (_, _, stem, _) in zip(word_pieces(column, ALNUM), word_pieces(column, ALNUM, STEM), strict=True):
        text = np.repeat(np.arange(j - i), np.diff(at))
        both = np.stack([h, stem], 1).ravel()
        yield j - i, np.repeat(text, 2), (both >> U64(64 - BITS)).astype(np.int64)


@dataclass
class Machine:
    """bias, weights and vectors of the kept buckets; slot maps a bucket to its row, -1 for none."""

    bias: float
    slot: np.ndarray
    weight: np.ndarray
    vector: np.ndarray

    def logits(self, column: pa.Array) -> np.ndarray:
        out = []
        m = len(self.weight)
        for n, text, bucket in _terms(column):
            row = self.slot[bucket]
            ok = row >= 0
            pair = np.unique(text[ok] * max(m, 1) + row[ok])
            text, row = pair // max(m, 1), pair % max(m, 1)
            z = self.bias + np.bincount(text, self.weight[row], n)
            for f in range(self.vector.shape[1]):
                v = self.vector[row, f]
                z += 0.5 * (np.bincount(text, v, n) ** 2 - np.bincount(text, v * v, n))
            out.append(z)
        return np.concatenate(out) if out else np.zeros(0)


def train_machine(label: np.ndarray, sets: list[np.ndarray], keep: int, prior: float, epochs: int = 20, seed: int = 5) -> Machine:
    """Fit by AdaGrad on the log loss.

    Buckets are those in three training texts or more whose presence tells the labels apart
    best (chi-square, 10 at least), ``keep`` at most; the others, those of most texts first, fill
    what room ``keep`` leaves, as their pairs may tell what they don't alone.
    prior is the share of label 1 among all labelled rows; the bias answers for a sample with
    another share.
    """
    n = len(label)
    prior = min(max(prior, 1e-6), 1 - 1e-6)
    if not n:
        return Machine(float(np.log(prior / (1 - prior))), np.full(1 << BITS, -1, np.int32), np.zeros(0), np.zeros((0, FACTORS)))
    text = np.repeat(np.arange(n), [len(s) for s in sets])
    bucket = np.concatenate(sets) if sets else np.zeros(0, np.int64)
    df = np.bincount(bucket, minlength=1 << BITS).astype(float)
    pos = np.bincount(bucket, label[text], 1 << BITS)
    n1 = max(label.sum(), 1e-9)
    n0 = max(n - label.sum(), 1e-9)
    a, b = pos, df - pos
    c, d = n1 - a, n0 - b
    with np.errstate(divide="ignore", invalid="ignore"):
        chi = n * (np.abs(a * d - b * c) - n / 2).clip(0) ** 2 / ((a + b) * (c + d) * n1 * n0)
    chi = np.where((df >= 3) & np.isfinite(chi) & (chi >= 10), chi, 0)
    telling = np.flatnonzero(chi)
    telling = telling[np.argsort(-chi[telling], kind="stable")[:keep]]
    common = np.flatnonzero((df >= 3) & (chi == 0))
    common = common[np.argsort(-df[common], kind="stable")[: keep - len(telling)]]
    kept = np.sort(np.concatenate([telling, common]))
    slot = np.full(1 << BITS, -1, np.int32)
    slot[kept] = np.arange(len(kept))
    rng = np.random.default_rng(seed)
    w, v = np.zeros(len(kept)), rng.normal(0, 0.02, (len(kept), FACTORS))
    bias = 0.0
    gw, gv = (np.where(chi[kept] > 0, 1e-6, damp) for damp in DAMP)
    gv, gb = np.repeat(gv[:, None], FACTORS, 1), 1e-6
    row = slot[bucket]
    ok = row >= 0
    text, row = text[ok], row[ok].astype(np.int64)
    first = np.searchsorted(text, np.arange(n + 1))
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(n), max(1, n // 64)):
            where = np.concatenate([np.arange(first[i], first[i + 1]) for i in part])
            t = np.repeat(np.arange(len(part)), first[part + 1] - first[part])
            r = row[where]
            s = np.stack([np.bincount(t, v[r, f], len(part)) for f in range(FACTORS)], 1)
            z = bias + np.bincount(t, w[r], len(part)) + 0.5 * (s**2).sum(1) - 0.5 * np.bincount(t, (v[r] ** 2).sum(1), len(part))
            err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - label[part]) / len(part)
            bias_grad = err.sum()
            gb += bias_grad**2
            bias -= 0.3 * bias_grad / np.sqrt(gb)
            touched, at = np.unique(r, return_inverse=True)
            g = np.bincount(at, err[t], len(touched)) + 1e-4 * w[touched]
            gw[touched] += g**2
            w[touched] -= 0.3 * g / np.sqrt(gw[touched])
            pair = err[t, None] * (s[t] - v[r])
            g = np.stack([np.bincount(at, pair[:, f], len(touched)) for f in range(FACTORS)], 1) + 1e-3 * v[touched]
            gv[touched] += g**2
            v[touched] -= 0.05 * g / np.sqrt(gv[touched])
    share = min(max(n1 / max(n, 1), 1e-6), 1 - 1e-6)
    bias += np.log(prior / (1 - prior)) - np.log(share / (1 - share))
    return Machine(float(bias), slot, w, v)


def _sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = []
        for n, text, bucket in _terms(batch.column("text")):
            at = np.searchsorted(text, np.arange(n + 1))
            sets += [np.unique(bucket[at[i] : at[i + 1]]).astype("<i4").tobytes() for i in range(n)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(sets, pa.binary())], ["doc_id", "label", "terms"])


def _learn(keep: int, prior: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((d, y, s) for b in batches for d, y, s in zip(*(c.to_pylist() for c in b.columns), strict=True))
        m = train_machine(np.array([r[1] for r in rows], float), [np.frombuffer(r[2], "<i4").astype(np.int64) for r in rows], keep, prior)
        kept = np.flatnonzero(m.slot >= 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array([x], pa.binary()) for x in (np.array([m.bias]).tobytes(), kept.astype("<i8").tobytes(), m.weight.tobytes(), m.vector.tobytes())],
            ["bias", "kept", "weight", "vector"],
        )

    return run


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", train_rows: int = 12_000, keep: int = 4_096) -> Machine:
    """Learn from labelled documents.

    At most ``train_rows`` rows are used, half of each label where there are enough, taken by
    hash of the id. Labels without document or value are left out; of several labels of one id
    the largest holds. Rows that repeat an id all count as examples of its label. Without both
    labels, or from empty tables, the machine scores the prior for every text.
    """
    spark = docs.sparkSession
    small_batches(spark)
    ws = Workspace(spark, "toxicity")
    told = (
        labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("double").alias("label"))
        .dropna()
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    prior = told.agg(F.avg("label")).first()[0] or 0.0
    halves = [told.filter(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows // 2) for y in (1.0, 0.0)]
    chosen = halves[0].union(halves[1])
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sample = rows.join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text")  # train_rows ids
    terms = ws.save(sample.mapInArrow(_sets_of, "doc_id long, label double, terms binary"), "terms")
    fitted = terms.coalesce(1).mapInArrow(_learn(keep, prior), "bias binary, kept binary, weight binary, vector binary").first()
    ws.drop("terms")
    if fitted is None:
        return train_machine(np.zeros(0), [], keep, prior)
    slot = np.full(1 << BITS, -1, np.int32)
    kept = np.frombuffer(fitted["kept"], "<i8")
    slot[kept] = np.arange(len(kept))
    return Machine(
        float(np.frombuffer(fitted["bias"])[0]), slot, np.frombuffer(fitted["weight"]), np.frombuffer(fitted["vector"]).reshape(len(kept), FACTORS)
    )


def toxicity(spark, text: Column, model: Machine) -> Column:
    """Probability of label 1, from 0 to 1, for every text; null counts as empty (the bias alone).

    Equal texts get equal scores; a term counts once however often it occurs, and a long text is read whole.
    """
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # 2**18 slots and ``keep`` vectors

    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        z = shared.value.logits(column)
        return pa.array(1 / (1 + np.exp(-np.clip(z, -700, 700))), pa.float64())

    return score(F.coalesce(text, F.lit("")))

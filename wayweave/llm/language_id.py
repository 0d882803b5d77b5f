"""Language identification by nearest centroid.

A text is its L2-normalised TF-IDF vector over hashed byte n-grams (two and three bytes, A-Z
lowered, everything in ASCII that is no letter as one space). Each language has several
centroids, the directions of a spherical k-means over its training texts. The nearest centroid
by cosine names the language; a text farther from it than the centroid's own training texts
reach is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayweave.llm import frequency_sketch as sketch
from wayweave.llm.bytetext import PIECE, buffers, pieces
from wayweave.plans.workspace import Workspace, small_batches

DIMS = 1 << 12
SALTS = 60
LETTERS = np.full(256, 0x20, np.uint8)
LETTERS[97:123] = np.arange(97, 123)
LETTERS[65:91] = np.arange(97, 123)
LETTERS[128:] = np.arange(128, 256)


def _features(d: np.ndarray) -> Iterator[np.ndarray]:
    """Hashed bigrams and trigrams; entry i begins at byte i."""
    b = d.astype(np.uint32)
    two = b[:-1] * np.uint32(257) + b[1:]
    yield (two * np.uint32(2654435761)) >> np.uint32(32 - 12)
    three = two[:-1] * np.uint32(263) + b[2:] + np.uint32(1 << 20)
    yield (three * np.uint32(2246822519)) >> np.uint32(32 - 12)


def counts(column: pa.Array) -> Iterator[np.ndarray]:
    """n-gram counts, a (texts, DIMS) array for each piece of the column, in order."""
    data, offs = buffers(column)
    parts = ((k, min(k + 256, j)) for i, j in pieces(offs) for k in range(i, j, 256))
    for i, j in parts:
        a, b = int(offs[i]), int(offs[j])
        out = np.zeros((j - i) * DIMS, np.int64)
        step = PIECE
        for s in range(a, max(b, a + 1), step):  # one step unless the text is long
            e = min(s + step + 2, b)
            d = LETTERS[data[s:e]]
            if len(d) < 3:
                continue
            text = np.searchsorted(offs[i : j + 1], np.arange(s, e), "right") - 1
            text = np.minimum(text, j - i - 1)
            for k, f in enumerate(_features(d)):
                n = len(f) if e == b else step
                f = f[:n]
                same = text[:n] == text[k + 1 : n + k + 1]
                blank = (d[:n] == 0x20) & (d[1 : n + 1] == 0x20)
                ok = same & ~blank
                out += np.bincount(text[:n][ok] * DIMS + f[ok], minlength=len(out))
        yield out.reshape(j - i, DIMS)


def weights(tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Normalised TF-IDF rows."""
    x = np.log1p(tf, dtype=np.float32) * idf
    norm = np.sqrt((x * x).sum(1, keepdims=True))
    return x / np.maximum(norm, np.float32(1e-12))


@dataclass
class Centroids:
    """A fitted model; its size is languages * clusters * DIMS floats."""

    langs: list[str]
    points: np.ndarray
    reach: np.ndarray
    idf: np.ndarray


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df, n = np.zeros(DIMS + 1, np.int64), 0
    for batch in batches:
        for tf in counts(batch.column("text")):
            df[:DIMS] += (tf > 0).sum(0)
            df[DIMS] += len(tf)
            n += int(tf.sum())
    yield pa.RecordBatch.from_arrays(
        [pa.array([0], pa.int32()), pa.array([n], pa.int64()), pa.array([sketch.pack(df)], pa.binary())], ["slice", "part", "counts"]
    )


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, tf = [], []
        for block in counts(batch.column("text")):
            for row in block:
                k = np.flatnonzero(row)
                at.append(k.astype("<i2").tobytes())
                tf.append(row[k].astype("<f4").tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("lang"), pa.array(at, pa.binary()), pa.array(tf, pa.binary())], ["lang", "at", "tf"]
        )


def _cluster(idf: np.ndarray, clusters: int):
    def fit(key: tuple, t: pa.Table) -> pa.Table:
        tf = np.zeros((len(t), DIMS), np.float32)
        rows = sorted(zip(t["at"].to_pylist(), t["tf"].to_pylist(), strict=True))
        for i, (at, v) in enumerate(rows):
            tf[i, np.frombuffer(at, "<i2")] = np.frombuffer(v, "<f4")
        x = weights(tf, idf)
        k = min(clusters, len(x))
        # farthest-first start from the mean direction, then spherical k-means
        centre = x[[int(np.argmax(x @ x.mean(0)))]]
        while len(centre) < k:
            centre = np.concatenate([centre, x[[int(np.argmin((x @ centre.T).max(1)))]]])
        for _ in range(12):
            own = (x @ centre.T).argmax(1)
            new = np.stack([x[own == c].sum(0) if (own == c).any() else centre[c] for c in range(k)])
            centre = new / np.maximum(np.linalg.norm(new, axis=1, keepdims=True), 1e-12)
        sims = x @ centre.T
        own, near = sims.argmax(1), sims.max(1)
        # reach: the cosine that all but a two-hundredth of the centroid's texts pass
        reach = [float(np.quantile(near[own == c], 0.005)) if (own == c).any() else 1.0 for c in range(k)]
        return pa.table(
            {
                "lang": pa.array([key[0].as_py()] * k, pa.string()),
                "point": pa.array([c.astype("<f4").tobytes() for c in centre], pa.binary()),
                "reach": pa.array(reach, pa.float64()),
            }
        )

    return fit


def fit(train: DataFrame, text_col: str = "text", lang_col: str = "lang", per_lang: int = 1500, clusters: int = 4, langs: int = 500) -> Centroids:
    """Learn from labelled rows.

    Document frequencies cover all rows of ``train``. Centroids are fitted on at most
    ``per_lang`` rows of each language, taken by hash of the text. Rows without language are left
    out; null texts are empty. Repeated rows count in the frequencies and are one row of a language's
    sample. An empty table gives a model without languages. The model is broadcast, so more than
    ``langs`` languages raise.
    """
    small_batches(train.sparkSession)
    rows = train.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.col(lang_col).alias("lang")).filter("lang IS NOT NULL")
    df = sketch.total(rows.select("text").mapInArrow(_frequencies, sketch.SCHEMA), size=DIMS + 1)
    idf = np.log((1 + df[DIMS]) / (1 + df[:DIMS])).astype(np.float32) + np.float32(1)
    if rows.select("lang").distinct().limit(langs + 1).count() > langs:
        raise ValueError(f"more than {langs} languages")
    # sample by hashes first, so that texts are not sorted, and from SALTS parts of a language,
    # so that no task orders a whole language
    mark = rows.select("lang", F.xxhash64("text").alias("mark")).distinct()
    first = Window.partitionBy("lang", F.pmod("mark", F.lit(SALTS))).orderBy("mark")
    chosen = mark.withColumn("k", F.row_number().over(first))
    chosen = chosen.filter(F.col("k") <= max(1, per_lang // SALTS)).drop("k")
    sample = (
        rows.withColumn("mark", F.xxhash64("text"))
        .join(F.broadcast(chosen), ["lang", "mark"])  # langs * per_lang rows at most
        .dropDuplicates(["lang", "mark"])
        .select("lang", "text")
    )
    ws = Workspace(train.sparkSession, "language")
    vectors = ws.save(sample.mapInArrow(_sparse, "lang string, at binary, tf binary"), "vectors")
    found = vectors.groupBy("lang").applyInArrow(_cluster(idf, clusters), "lang string, point binary, reach double").collect()
    ws.drop("vectors")
    found.sort(key=lambda r: (r["lang"], bytes(r["point"])))
    points = np.stack([np.frombuffer(r["point"], "<f4") for r in found]) if found else np.zeros((0, DIMS), np.float32)
    return Centroids([r["lang"] for r in found], points, np.array([r["reach"] for r in found]), idf)


def identify(spark, text: Column, model: Centroids) -> Column:
    """struct(lang, score, rejected) of a text column.

    lang is the nearest centroid's language, `und` for null, for a text without any letter, and
    without a model; score is the cosine, from 0 to 1; rejected tells that the text lies beyond
    the centroid's reach (always with `und`). Of equally near centroids that of the first language
    by name holds. Equal texts get equal results; a long text is counted in parts, whole.
    """
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang:string,score:double,rejected:boolean>")
    def nearest(column: pa.Array) -> pa.Array:
        m = shared.value
        lang, score, out = [], [], []
        for tf in counts(column):
            sims = weights(tf.astype(np.float32), m.idf) @ m.points.T
            best = sims.argmax(1)
            top = np.clip(sims[np.arange(len(sims)), best], 0, 1).astype(np.float64)
            lang += [m.langs[c] for c in best]
            score.append(top)
            out.append(top < m.reach[best])
        cat = lambda x, kind: pa.array(np.concatenate(x) if x else [], kind)
        return pa.StructArray.from_arrays(
            [pa.array(lang, pa.string()), cat(score, pa.float64()), cat(out, pa.bool_())], ["lang", "score", "rejected"]
        )

    none = F.struct(F.lit("und").alias("lang"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    if not model.langs:
        return none
    letters = F.coalesce(text, F.lit("")).rlike(r"\p{L}")
    return F.when(letters, nearest(F.coalesce(text, F.lit("")))).otherwise(none)


def held_out(id_col: Column) -> Column:
    """Rows kept from learning: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))

"""Similarity digests of improbable features (after Roussev, 2010).

Every window of WINDOW bytes of a text has an entropy, cut into LEVELS levels. How many windows
of the whole corpus fall on a level makes it probable or improbable. Among NEIGHBOURS windows in
succession the most improbable one, the leftmost of equals, gets a vote; windows with POPULAR
votes or more are features. Features are inserted, in order, into Bloom filters of BITS bits,
FULL features each, which are chained. Two digests are alike by the bits that their filters share
beyond chance.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayweave.llm import bytetext
from wayweave.plans.workspace import small_batches

WINDOW, LEVELS, NEIGHBOURS, POPULAR = 16, 1000, 32, 8
BITS, HASHES, FULL, SLACK = 2048, 5, 160, 0.3
#: count * log2(count) in fixed point: entropies are whole numbers, so equal windows have equal ones.
_C = np.arange(WINDOW + 1)
MASS = np.rint(_C * np.log2(np.maximum(_C, 1)) * (1 << 20)).astype(np.int64)
_POS = 32


@dataclass(frozen=True)
class Rarity:
    """Place of each entropy level among all, the most improbable first."""

    rank: np.ndarray


def levels_of(d: np.ndarray) -> np.ndarray:
    """Entropy level of each window of the bytes, 0 for one byte repeated.

    A window's entropy follows from its neighbour's by the byte that leaves and the byte that
    comes, for which it takes how often each byte stands in the window before and after it.
    """
    n = len(d) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    back, ahead = np.zeros(len(d), np.uint8), np.zeros(len(d), np.uint8)
    for k in range(1, WINDOW):
        same = d[k:] == d[:-k]
        back[k:] += same
        ahead[:-k] += same
    gain = np.diff(MASS)
    mass = np.empty(n, np.int64)
    mass[0] = MASS[np.bincount(d[:WINDOW])].sum()
    np.cumsum(gain[back[WINDOW:]] - gain[ahead[: n - 1]], out=mass[1:])
    mass[1:] += mass[0]
    return np.minimum((MASS[WINDOW] - mass) * LEVELS // MASS[WINDOW], LEVELS - 1)


def _spans(offs: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(first text, past text, first byte, past byte): texts together, or parts of one long text."""
    for i, j in bytetext.pieces(offs):
        if offs[j] - offs[i] <= bytetext.PIECE:
            yield i, j, int(offs[i]), int(offs[j])
            continue
        for a in range(int(offs[i]), int(offs[j]), bytetext.PIECE):
            yield i, j, a, min(a + bytetext.PIECE, int(offs[j]))


def _part(data: np.ndarray, offs: np.ndarray, i: int, j: int, a: int, b: int, past: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of a span and up to ``past`` more of its last text; each byte's text and that text's end."""
    stop = min(b + past, int(offs[j]))
    edges = np.clip(offs[i : j + 1], a, stop) - a
    size = np.diff(edges)
    return data[a:stop], np.repeat(np.arange(i, j), size), np.repeat(edges[1:], size)


def level_counts(column: pa.Array) -> np.ndarray:
    """Windows of each level in a column of texts."""
    data, offs = bytetext.buffers(column)
    total = np.zeros(LEVELS, np.int64)
    for i, j, a, b in _spans(offs):
        d, _, stop = _part(data, offs, i, j, a, b, WINDOW - 1)
        level = levels_of(d)
        at = np.arange(len(level))
        total += np.bincount(level[(at + WINDOW <= stop[: len(level)]) & (at < b - a)], minlength=LEVELS)
    return total


def fit_rarity(docs: DataFrame, text_col: str = "text") -> Rarity:
    """Count the windows of all texts by level; LEVELS numbers come to the driver.

    Levels rank by count, the lowest first (of equal counts the lower level). Null and empty
    texts add nothing; without any text the levels rank in their own order.
    """
    small_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(LEVELS, np.int64)
        for batch in batches:
            total += level_counts(batch.column(0))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(LEVELS), pa.int32()), pa.array(total)], ["level", "n"])

    counts = docs.select(F.col(text_col).alias("text")).mapInArrow(work, "level int, n long").groupBy("level").agg(F.sum("n").alias("n"))
    found = np.zeros(LEVELS, np.int64)
    for r in counts.collect():
        found[r.level] = r.n
    rank = np.empty(LEVELS, np.int64)
    rank[np.argsort(found, kind="stable")] = np.arange(LEVELS)
    return Rarity(rank)


def _votes(d: np.ndarray, text: np.ndarray, stop: np.ndarray, starts: int, rarity: Rarity) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, votes) of the windows that the first ``starts`` windows' neighbourhoods vote for."""
    level = levels_of(d)
    at = np.arange(len(level))
    fits = at + WINDOW <= stop[: len(level)]
    key = (text[: len(level)] << 44) | (rarity.rank[level] << _POS) | at
    key[~fits] = np.iinfo(np.int64).max
    step = 1
    while step < NEIGHBOURS:  # the least of a text's own neighbours; later texts have larger keys
        key[:-step] = np.minimum(key[:-step], key[step:])
        step *= 2
    chosen = key[fits & (at < starts)] & ((1 << _POS) - 1)
    edge = np.flatnonzero(np.diff(chosen, prepend=-1))
    place = chosen[edge]
    return text[place], place, np.diff(edge, append=len(chosen))


def _hashes(d: np.ndarray, place: np.ndarray, end: np.ndarray) -> np.ndarray:
    up, down = bytetext.powers(len(d) + 1)
    sums = np.zeros(len(d) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum((d.astype(np.uint64) + np.uint64(1)) * up[: len(d)], out=sums[1:])
        h = (sums[end] - sums[place]) * down[place]
        return bytetext.mix(h + (end - place).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _features(column: pa.Array, rarity: Rarity) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the features, in order, each once a text."""
    data, offs = bytetext.buffers(column)
    size = np.diff(offs)
    parts = []
    for i, j, a, b in _spans(offs):
        d, text, stop = _part(data, offs, i, j, a, b, WINDOW + NEIGHBOURS - 2)
        t, place, votes = _votes(d, text, stop, b - a, rarity)
        parts.append((t, place + a, votes, _hashes(d, place, place + WINDOW)))
        if a == offs[i]:  # texts shorter than a window are one feature
            short = np.flatnonzero((size[i:j] > 0) & (size[i:j] < WINDOW)) + i
            parts.append((short, offs[short], np.full(len(short), POPULAR), _hashes(d, offs[short] - a, offs[short + 1] - a)))
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    text, place, votes, h = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.argsort(place, kind="stable")
    text, place, votes, h = text[order], place[order], votes[order], h[order]
    first = np.flatnonzero(np.diff(place, prepend=-1))  # a place may have votes from two parts of a text
    votes = np.add.reduceat(votes, first) if len(first) else votes
    text, h = text[first], h[first]
    most = np.zeros(len(size), np.int64)
    np.maximum.at(most, text, votes)
    keep = np.flatnonzero(votes >= np.minimum(most[text], POPULAR))
    few = np.flatnonzero(most[text[keep]] < POPULAR)  # of these the leftmost is enough
    drop = few[1:][text[keep[few[1:]]] == text[keep[few[:-1]]]]
    keep = np.delete(keep, drop)
    text, h = text[keep], h[keep]
    by = np.lexsort((np.arange(len(h)), h, text))
    again = (np.diff(text[by], prepend=-1) == 0) & (h[by] == np.roll(h[by], 1))
    once = np.sort(by[~again])
    return text[once], h[once]


def fingerprints(column: pa.Array, rarity: Rarity) -> list[np.ndarray]:
    """Chained filters of each text, as rows of BITS / 8 bytes; none for null and empty texts."""
    text, h = _features(column, rarity)
    count = np.bincount(text, minlength=len(column)).astype(np.int64)
    filters = -(-count // FULL)
    base = np.concatenate([[0], np.cumsum(filters)])
    nth = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    bits = np.zeros((int(base[-1]), BITS), bool)
    row = base[text] + nth // FULL
    wide = BITS.bit_length() - 1
    for k in range(HASHES):
        bits[row, ((h >> np.uint64(k * wide)) & np.uint64(BITS - 1)).astype(np.int64)] = True
    packed = np.packbits(bits, axis=1)
    return [packed[base[i] : base[i + 1]] for i in range(len(column))]


def _toward(x: np.ndarray, y: np.ndarray) -> float:
    nx, ny = np.bitwise_count(x).sum(1, dtype=np.int64), np.bitwise_count(y).sum(1, dtype=np.int64)
    best, rows = np.zeros(len(x)), max((1 << 20) // (len(y) * x.shape[1]), 1)
    for a in range(0, len(x), rows):
        part = slice(a, a + rows)
        common = np.bitwise_count(x[part, None, :] & y[None]).sum(2, dtype=np.int64)
        most, chance = np.minimum(nx[part, None], ny[None]), nx[part, None] * ny[None] / BITS
        cut = chance + SLACK * (most - chance)
        best[part] = ((common - cut) / np.maximum(most - cut, 1e-9)).clip(0, 1).max(axis=1)
    return float(best @ nx / nx.sum())


def alike(a: np.ndarray, b: np.ndarray) -> float:
    """Likeness of two digests, from 0 to 1: 1 if equal, also of two empty ones; 0 if one is empty.

    A pair of filters is worth its common bits beyond what chance and SLACK give, as a share of
    the most it could have. Each filter of the shorter chain counts with its best partner, by its
    bits; of chains of equal length both ways are averaged.
    """
    if a.shape == b.shape and (a == b).all():
        return 1.0
    if not len(a) or not len(b):
        return 0.0
    a, b = (np.ascontiguousarray(v).view(np.uint64) for v in (a, b))
    if len(a) == len(b):
        return (_toward(a, b) + _toward(b, a)) / 2
    return _toward(a, b) if len(a) < len(b) else _toward(b, a)


def fingerprint(spark: SparkSession, text: Column, rarity: Rarity) -> Column:
    """Digest of each text as lowercase hex; the empty string for null and empty texts."""
    small_batches(spark)

    @F.arrow_udf("string")
    def run(column: pa.Array) -> pa.Array:
        return pa.array([v.tobytes().hex() for v in fingerprints(column, rarity)], pa.string())

    return run(F.coalesce(text, F.lit("")))


def likeness(a: Column, b: Column) -> Column:
    """``alike`` of two digests in hex."""

    @F.arrow_udf("double")
    def run(left: pa.Array, right: pa.Array) -> pa.Array:
        of = lambda s: np.frombuffer(bytes.fromhex(s), np.uint8).reshape(-1, BITS // 8)
        return pa.array([alike(of(x), of(y)) for x, y in zip(left.to_pylist(), right.to_pylist(), strict=True)], pa.float64())

    return run(a, b)


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> DataFrame:
    """One row per input row: its doc_id, text, next_text, and edited.

    The next row is the one that follows by doc_id; after the last comes the first. Nulls are
    first; rows of one id follow by hash of the text, then by text. edited is the text whose last
    quarter, floor(code points / 4), is replaced by as many first code points of the next text, or
    all it has. Null texts count as empty.

    Ranges of ids are found from the ids and hashes alone, of ``parts`` ranges (as many as shuffle
    partitions) the least key comes to the driver. Each text is shuffled once to its range, and a range's first
    text also to the range before, so every row finds the next one in its own task. Rows equal in
    id and text are in one range.
    """
    spark = docs.sparkSession
    small_batches(spark)
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    ranged = rows.select("doc_id", "h").repartitionByRange(parts, "doc_id", "h").groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct("doc_id", "h")).alias("m"))
    order = lambda i, h: (i is not None, 0 if i is None else i, h)
    heads = sorted(order(r.m.doc_id, r.m.h) for r in ranged.collect())  # one key a range

    @F.arrow_udf("array<int>")
    def ranges(i: pa.Array, h: pa.Array) -> pa.Array:
        out = []
        for key in map(order, i.to_pylist(), h.to_pylist()):
            k = bisect.bisect_right(heads, key) - 1
            out.append([k, (k - 1) % len(heads)] if heads[k] == key else [k])
        return pa.array(out, pa.list_(pa.int32()))

    dealt = rows.select("doc_id", "text", "h", F.posexplode(ranges("doc_id", "h")).alias("guest", "range"))
    dealt = dealt.repartitionById(max(len(heads), 1), "range").sortWithinPartitions("range", "guest", "doc_id", "h", "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, out, size = None, [], 0
        for batch in batches:
            shape = batch.schema.field("doc_id").type
            for row in zip(*(batch.column(c).to_pylist() for c in ("range", "guest", "doc_id", "text")), strict=True):
                if held and not held[1] and held[0] == row[0]:
                    n = len(held[3]) // 4
                    out.append((held[2], held[3], held[3][: len(held[3]) - n] + row[3][:n], row[3]))
                    size += len(held[3]) * 2 + len(row[3])
                held = row
                if size > 1 << 22:
                    yield _rows(out, shape)
                    out, size = [], 0
            if out:
                yield _rows(out, shape)
                out, size = [], 0

    return dealt.select("range", "guest", "doc_id", "text").mapInArrow(work, f"doc_id {kind}, text string, edited string, next_text string")


def _rows(out: list[tuple], shape: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*out, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(columns[0], shape), *[pa.array(c, pa.string()) for c in columns[1:]]], ["doc_id", "text", "edited", "next_text"])


def compare_edited(docs: DataFrame, rarity: Rarity, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's digest beside that of its edited text and of the next row (see ``with_next``).

    doc_id, n_chars (code points), edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next. One row per input row, repeated rows and ids included; null texts count as empty; a
    sole row is its own next one; an empty table gives no rows; other columns are ignored. A text
    is worked on whole in one task, in parts of a quarter of a megabyte.
    """
    spark = docs.sparkSession
    rows = with_next(docs, id_col, text_col)
    told = rows.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(spark, F.col("text"), rarity).alias("fingerprint"),
        fingerprint(spark, F.col("edited"), rarity).alias("edited_fingerprint"),
        fingerprint(spark, F.col("next_text"), rarity).alias("_next"),
    )
    near = {"near_edited": likeness(F.col("fingerprint"), F.col("edited_fingerprint")), "near_next": likeness(F.col("fingerprint"), F.col("_next"))}
    return told.withColumns(near).drop("_next")

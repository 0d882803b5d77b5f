"""Benchmark decontamination by the q-gram lemma.

A document region within ``e`` edits of an item of ``n`` characters shares at least
``n - q + 1 - q * e`` of the item's q-grams with it, all on diagonals no farther apart than
``e``. Shared q-grams are counted in overlapping diagonal bands of width ``2 e``; bands that
reach the bound are kept, and a banded alignment of the item in the band's region verifies them.
Texts are compared as lower-cased letters and digits with single spaces between words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayweave.llm.bytetext import ALNUM, BASE, LOWER, PIECE, U64, buffers, mix, pieces
from wayweave.plans.workspace import small_batches

Q = 12
PLAIN = np.where(ALNUM[LOWER], LOWER, 0x20).astype(np.uint8)


def grams(d: np.ndarray) -> np.ndarray:
    """Fingerprints of the Q-grams at each byte."""
    if len(d) < Q:
        return np.zeros(0, U64)
    with np.errstate(over="ignore"):
        b2 = BASE * BASE
        b4 = b2 * b2
        h = d.astype(U64) + U64(1)
        h = h[:-1] * BASE + h[1:]
        h = h[:-2] * b2 + h[2:]
        h8 = h[:-4] * b4 + h[4:]
        return mix(h8[:-4] * b4 + h[8:])


def squeezed(d: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Plain bytes with one space for each run of them, and where each byte stood.

    At ``cut`` a new text begins; a space run does not reach over it.
    """
    p = PLAIN[d]
    keep = np.ones(len(p), bool)
    keep[1:] = (p[1:] != 0x20) | (p[:-1] != 0x20)
    keep[cut] = True
    return p[keep], np.flatnonzero(keep)


def plain(text: str | None) -> bytes:
    d = np.frombuffer((text or "").encode(), np.uint8)
    return squeezed(d, np.zeros(0, np.int64))[0].tobytes().strip(b" ")


def align(item: bytes, region: bytes, limit: int) -> tuple[int, int, int] | None:
    """Fewest edits that turn the whole item into a part of the region: (edits, start, stop).

    Rows are the item's bytes; only cells within ``limit`` of the region's diagonals are filled,
    so the band is as wide as the region is longer than the item, plus the limit each way. None
    if more than ``limit`` edits are needed.
    """
    at = region.find(item)
    if at >= 0:
        return 0, at, at + len(item)
    r = np.frombuffer(region, np.uint8)
    n, m = len(item), len(region)
    width = max(m - n, 0) + 2 * limit + 1
    low = -limit  # band cell c of row i is region column i + low + c
    big = 1 << 20
    cells = np.arange(width)
    cost = np.where((cells + low >= 0) & (cells + low <= m), 0, big)
    start = np.clip(cells + low, 0, m)
    for i in range(1, n + 1):
        col = i + low + cells
        ok = (col >= 0) & (col <= m)
        byte = np.where((col >= 1) & (col <= m), r[np.clip(col - 1, 0, max(m - 1, 0))], 256) if m else np.full(width, 256)
        diag = cost + (byte != item[i - 1])
        up = np.append(cost[1:], big) + 1
        best = np.where(up < diag, up, diag)
        begin = np.where(up < diag, np.append(start[1:], 0), start)
        best = np.where(ok, best, big)
        # along the row: region bytes that the item lacks
        run = np.minimum.accumulate(best - cells)
        from_left = run + cells
        source = np.maximum.accumulate(np.where(best - cells == run, cells, 0))
        begin = np.where(from_left < best, begin[source], begin)
        cost, start = np.where(ok, np.minimum(best, from_left), big), begin
        if cost.min() > limit:
            return None
    c = int(cost.argmin())
    edits = int(cost[c])
    return (edits, int(start[c]), n + low + c) if edits <= limit else None


@dataclass
class Items:
    """A block of benchmark items with the index of their q-grams."""

    ids: list[int]
    texts: list[bytes]
    budget: np.ndarray
    bound: np.ndarray
    gram: np.ndarray = field(default_factory=lambda: np.zeros(0, U64))
    item: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    at: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    seen: np.ndarray = field(default_factory=lambda: np.zeros(1 << 22, bool))
    short: list[int] = field(default_factory=list)


def index(rows: list[tuple[int, str | None]], rate: float) -> Items:
    """Index a block of (id, text)."""
    texts = [plain(t) for _, t in rows]
    size = np.array([len(t) for t in texts], np.int64)
    # the largest budget within the rate that leaves a positive bound
    budget = np.minimum((size * rate).astype(np.int64), np.maximum(size - Q, 0) // Q)
    out = Items([i for i, _ in rows], texts, budget, size - Q + 1 - Q * budget)
    out.short = [k for k, t in enumerate(texts) if 0 < len(t) < Q]
    parts = [grams(np.frombuffer(t, np.uint8)) for t in texts]
    if parts:
        gram = np.concatenate(parts)
        order = np.argsort(gram, kind="stable")
        out.gram = gram[order]
        out.item = np.repeat(np.arange(len(texts)), [len(p) for p in parts])[order]
        out.at = np.concatenate([np.arange(len(p)) for p in parts])[order]
        out.seen[(gram >> U64(42)).astype(np.int64)] = True
    return out


def _hits(found: Items, p: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(text, item, band start) of bands that reach the bound, over squeezed bytes."""
    h = grams(p)
    pos = np.flatnonzero(found.seen[(h >> U64(42)).astype(np.int64)])
    if not len(pos):
        return
    left = np.searchsorted(found.gram, h[pos], "left")
    n = np.searchsorted(found.gram, h[pos], "right") - left
    pos, left, n = pos[n > 0], left[n > 0], n[n > 0]
    if not len(pos):
        return
    row = np.repeat(left, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    pos = np.repeat(pos, n)
    text = np.searchsorted(bounds, pos, "right") - 1
    inside = pos + Q <= bounds[text + 1]
    pos, row, text = pos[inside], row[inside], text[inside]
    item = found.item[row]
    half = np.maximum(found.budget[item], 1)
    diagonal = pos - found.at[row] - bounds[text]
    band = diagonal // half
    # every diagonal lies in two bands of width 2 * half
    key = np.stack([np.tile(text, 2), np.tile(item, 2), np.concatenate([band, band - 1])])
    order = np.lexsort(key[::-1])
    key = key[:, order]
    new = np.flatnonzero(np.append(True, (key[:, 1:] != key[:, :-1]).any(0)))
    count = np.diff(np.append(new, key.shape[1]))
    good = count >= found.bound[key[1, new]]
    for t, i, b in key[:, new[good]].T.tolist():
        yield t, i, b * int(max(found.budget[i], 1))


def matches(column: pa.Array, found: Items) -> Iterator[tuple[int, int, int, int, int]]:
    """(row, item, start byte, stop byte, edits): the best place of each item in each text."""
    data, offs = buffers(column)
    longest = max((len(t) + 4 * int(e) for t, e in zip(found.texts, found.budget, strict=True)), default=0)
    done: dict[tuple[int, bytes], tuple[int, int, int] | None] = {}
    best: dict[tuple[int, int], tuple[int, int, int]] = {}

    def stretch(i: int, j: int, a: int, b: int) -> None:
        bounds = np.clip(offs[i : j + 1] - a, 0, b - a)
        cut = np.unique(bounds[(bounds > 0) & (bounds < b - a)])
        p, stood = squeezed(data[a:b], cut)
        ends = np.searchsorted(stood, bounds)
        base = a - offs[i:j]  # of a long text the stretch begins inside

        def note(t: int, k: int, hit: tuple[int, int, int], at: int) -> None:
            edits, s, e = hit
            lo = int(ends[t]) + at + s
            hi = int(ends[t]) + at + e - 1
            span = (edits, int(stood[lo]) + int(base[t]), int(stood[hi]) + 1 + int(base[t]))
            if (old := best.get((i + t, k))) is None or span < old:
                best[i + t, k] = span

        for t, k, begin in _hits(found, p, ends):
            e = int(found.budget[k])
            lo = max(begin - e, 0)
            hi = begin + 2 * max(e, 1) + len(found.texts[k]) + e
            region = p[ends[t] + lo : min(ends[t] + hi, ends[t + 1])].tobytes()
            if (key := (k, region)) not in done:
                if len(done) > 50_000:
                    done.clear()
                done[key] = align(found.texts[k], region, e)
            if (hit := done[key]) is not None and hit[2] > hit[1]:
                note(t, k, hit, lo)
        if found.short:
            whole = p.tobytes()
            for k in found.short:
                at = whole.find(found.texts[k])
                while at >= 0:
                    t = int(np.searchsorted(ends, at, "right")) - 1
                    n = len(found.texts[k])
                    edge = (at == ends[t] or p[at - 1] == 0x20) and (at + n == ends[t + 1] or at + n < len(p) and p[at + n] == 0x20)
                    if at + n <= ends[t + 1] and edge:
                        note(t, k, (0, at - int(ends[t]), at - int(ends[t]) + n), 0)
                    at = whole.find(found.texts[k], at + 1)

    for i, j in pieces(offs):
        a, b = int(offs[i]), int(offs[j])
        if b - a <= PIECE:
            if b > a:
                stretch(i, j, a, b)
            continue
        # stretches of a long text overlap by more than any region takes; more if it is mostly blanks
        while a < b:
            end, lap = min(a + PIECE, b), longest
            stop = end
            while stop < b:
                stop = min(end + 4 * lap, b)
                if (PLAIN[data[end:stop]] != 0x20).sum() >= longest:
                    break
                lap *= 2
            stretch(i, j, a, stop)
            a = end
    for (row, k), (edits, s, e) in best.items():
        yield row, found.ids[k], s, e, edits


def blocks(benchmark: DataFrame, id_col: str, text_col: str, rate: float, size: int) -> Iterator[Items]:
    """The benchmark as indexed blocks of at most ``size`` items."""
    rows = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text")).orderBy("item_id", "text")
    block: list[tuple[int, str | None]] = []
    for r in rows.toLocalIterator():  # the stated query set, a block at a time
        block.append((r[0], r[1]))
        if len(block) == size:
            yield index(block, rate)
            block = []
    if block:
        yield index(block, rate)


def find_items(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text", rate: float = 0.06, block: int = 5_000,
) -> DataFrame:
    """(doc_id, item_id, start, stop, edits): the best place of each benchmark item in each document.

    An item is found where at most ``rate`` of its characters (fewer if the lemma's bound would
    not be positive) are edited; start and stop are bytes of the document. Items under Q
    characters are found as whole words without edits; items without letters or digits, and
    null ones, never. Null and empty documents hold nothing. Repeated rows and ids give a row
    each. Empty tables give no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shape = "doc_id long, item_id long, start long, stop long, edits int"
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    out = spark.createDataFrame([], shape)
    for found in blocks(benchmark, item_col, item_text, rate, block):
        shared = spark.sparkContext.broadcast(found)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                got = list(matches(batch.column("text"), shared.value))
                row, item, start, stop, edits = zip(*got, strict=True) if got else [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array(item, pa.int64()), pa.array(start, pa.int64()), pa.array(stop, pa.int64()), pa.array(edits, pa.int32())],
                    ["doc_id", "item_id", "start", "stop", "edits"],
                )

        out = out.union(rows.mapInArrow(search, shape))
    return out


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
    rate: float = 0.06, block: int = 5_000,
) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns; see find_items."""
    spark = docs.sparkSession
    small_batches(spark)
    for found in blocks(benchmark, item_col, item_text, rate, block):
        clean = _clean(spark.sparkContext.broadcast(found))
        docs = docs.filter(clean(F.coalesce(F.col(text_col), F.lit(""))))
    return docs


def _clean(shared):
    """Whether a text holds none of a broadcast block's items."""

    @F.arrow_udf("boolean")
    def clean(column: pa.Array) -> pa.Array:
        out = np.ones(len(column), bool)
        for row, *_ in matches(column, shared.value):
            out[row] = False
        return pa.array(out)

    return clean

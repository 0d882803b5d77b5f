"""Removal of repeated byte strings by sorting suffixes, deep-shallow.

Of every string of ``length`` bytes that occurs more than once, all occurrences but the first
(smallest doc_id, then smallest start) are covered bytes, and covered bytes go.

Sorting every suffix of the corpus would move eight times its size. Only sampled suffixes are
sorted: each window of ``length`` bytes has one anchor, the least of its k-grams in a fixed
order, so equal windows have equal anchors at equal offsets. Neighbouring windows with one
anchor form a run, about one for every 38 bytes. Anchors are dealt by fingerprint; identical
runs are one string, of which the first occurrence is kept; the remaining runs of an anchor are
sorted as suffixes that begin at the anchor, by multikey quicksort to a shallow depth and by
blind tries below it, and their common prefixes, together with the common bytes before the
anchor, tell which windows are repeats.

K-grams are ordered rare first by a sketch of the whole corpus. So an anchor that many texts
share lies in a passage whose k-grams are all common, and its runs are alike. Should an anchor
still hold more than ``many`` different runs, its windows are grouped by their bytes instead.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayweave.llm import frequency_sketch as sketch
from wayweave.llm.bytetext import BASE, PIECE, U64, as_long, buffers, mix, pieces
from wayweave.plans.workspace import Workspace, small_batches

K = 24
HOT_SALTS = 32
#: Spans to broadcast at most, 8 bytes each; beyond them the spans and the texts are joined by shuffle.
BROADCAST_ROWS = 1_000_000
NO_ID = -(1 << 63)


# ---------------------------------------------------------------- sorting


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (x.bit_length() + 7) // 8


class BlindTrie:
    """Strings in a trie that keeps branching depths only.

    A string is placed by one blind descent, one comparison with the leaf found, and a climb to
    the depth of the first difference.
    """

    def __init__(self, strings: Sequence[bytes]):
        self.strings = strings
        self.root: list | int | None = None  # a leaf is a string's number, a node [depth, {byte: child}]

    def _byte(self, i: int, depth: int) -> int:
        s = self.strings[i]
        return s[depth] if depth < len(s) else -1

    def add(self, i: int) -> None:
        if self.root is None:
            self.root = i
            return
        node = self.root
        while isinstance(node, list):  # blind: the depths between branches are not looked at
            child = node[1].get(self._byte(i, node[0]))
            node = child if child is not None else next(iter(node[1].values()))
        if isinstance(node, tuple):
            leaf = node[0]
        else:
            leaf = node
        depth = _common(self.strings[i], self.strings[leaf])
        same = depth == len(self.strings[i]) == len(self.strings[leaf])
        parent, key, node = None, None, self.root
        while isinstance(node, list) and (node[0] < depth or same and node[0] == depth):
            parent, key = node, self._byte(i, node[0])
            node = node[1][key]
        if same:
            new: list | tuple | int = (*node, i) if isinstance(node, tuple) else (node, i)
        elif isinstance(node, list) and node[0] == depth:
            node[1][self._byte(i, depth)] = i
            return
        else:
            other = node
            while isinstance(other, list):
                other = next(iter(other[1].values()))
            other = other[0] if isinstance(other, tuple) else other
            new = [depth, {self._byte(other, depth): node, self._byte(i, depth): i}]
        if parent is None:
            self.root = new
        else:
            parent[1][key] = new

    def order(self) -> list[int]:
        out, todo = [], [self.root]
        while todo:
            node = todo.pop()
            if isinstance(node, list):
                todo += [node[1][b] for b in sorted(node[1], reverse=True)]
            elif isinstance(node, tuple):
                out += node
            else:
                out.append(node)
        return out


def deep_shallow_sort(strings: Sequence[bytes], shallow: int = 32) -> tuple[list[int], list[int]]:
    """Order of the strings, and the common prefix of each with the one before it (0 for the first).

    Three-way quicksort on single bytes down to ``shallow``; groups that still agree there are
    ordered by a blind trie.
    """
    order: list[int] = []
    todo: list[tuple[list[int], int]] = [(list(range(len(strings))), 0)]
    while todo:
        group, depth = todo.pop()
        if len(group) < 2:
            order += group
            continue
        if depth < 0:  # ended strings, all equal
            order += group
            continue
        if depth >= shallow:
            trie = BlindTrie(strings)
            for i in group:
                trie.add(i)
            order += trie.order()
            continue
        at = lambda i: strings[i][depth] if depth < len(strings[i]) else -1  # noqa: B023, E731
        pivot = at(group[len(group) // 2])
        less, equal, more = [], [], []
        for i in group:
            b = at(i)
            (equal if b == pivot else less if b < pivot else more).append(i)
        if more:
            todo.append((more, depth))
        todo.append((equal, depth + 1 if pivot >= 0 else -1))
        if less:
            todo.append((less, depth))
    lcp = [0] + [_common(strings[a], strings[b]) for a, b in zip(order, order[1:], strict=False)]
    return order, lcp


def repeated_windows(
    left: Sequence[bytes], right: Sequence[bytes], rank: Sequence[int], length: int
) -> list[tuple[int, int, int]]:
    """(run, least, most): windows with least..most bytes before the anchor repeat an earlier run's.

    ``right`` is each run from its anchor on, ``left`` what stands before it, reversed; rank is
    the runs' order in the corpus. The suffixes are sorted, and each run looks along the order
    both ways while enough of the suffix is common.
    """
    order, lcp = deep_shallow_sort(right)
    out = []
    n = len(order)
    for k, i in enumerate(order):
        need = length - len(left[i])
        for step in (-1, 1):
            j, common = k, len(right[i])
            while 0 <= j + step < n:
                common = min(common, lcp[j] if step < 0 else lcp[j + 1])
                if common < need:
                    break
                j += step
                other = order[j]
                if rank[other] < rank[i]:
                    before = _common(left[i], left[other])
                    if before + common >= length:
                        out.append((i, max(0, length - common), min(before, length)))
    return out


# ---------------------------------------------------------------- anchors


def kgram_prints(d: np.ndarray) -> np.ndarray:
    """Fingerprints of the K-grams at each byte, by doubling."""
    with np.errstate(over="ignore"):
        b2 = BASE * BASE
        b4 = b2 * b2
        b8 = b4 * b4
        h = d.astype(U64) + U64(1)
        h = h[:-1] * BASE + h[1:]
        h = h[:-2] * b2 + h[2:]
        h8 = h[:-4] * b4 + h[4:]
        h16 = h8[:-8] * b8 + h8[8:]
        return mix(h16[:-8] * b8 + h8[16:])


def _stretches(offs: np.ndarray, length: int) -> Iterator[tuple[int, int, int, int]]:
    """(first text, past text, first byte, past byte) to look at together.

    Longer texts come in stretches that overlap by length - 1 bytes, so each window is in one.
    """
    for i, j in pieces(offs):
        a, b = int(offs[i]), int(offs[j])
        if b - a <= PIECE:
            yield i, j, a, b
            continue
        while a + length <= b:
            yield i, j, a, min(a + PIECE + length - 1, b)
            a += PIECE


def _count(length: int):
    """The slices of each task's k-gram counters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, part, some = sketch.Counter(), 0, False
        for batch in batches:
            data, offs = buffers(batch.column("text"))
            part = (part * 31 + int(offs[-1])) & 0x7FFFFFFFFFFF
            for _, _, a, b in _stretches(offs, length):
                if b - a >= length:
                    counter.add(kgram_prints(data[a:b]))
                    some = True
        if some:
            rows = list(counter.slices())
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array([part] * len(rows), pa.int64()), pa.array([r[1] for r in rows], pa.binary())],
                ["slice", "part", "counts"],
            )

    return run


def runs_of(d: np.ndarray, bounds: np.ndarray, classes: np.ndarray, length: int):
    """Runs of windows with one anchor: text number, first window, last window, anchor, prints.

    ``bounds`` are the texts' ends in ``d``, with 0 first.
    """
    w = length - K + 1
    prints = kgram_prints(d)
    low = U64((1 << 24) - 1)
    least = (sketch.order_key(prints, classes) & ~low) | np.arange(len(prints), dtype=U64)
    span = 1
    while span * 2 <= w:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < w:
        least = np.minimum(least[: len(least) - (w - span)], least[w - span :])
    anchor = (least & low).astype(np.int64)
    p = np.arange(len(anchor))
    text = np.searchsorted(bounds, p, "right") - 1
    ok = p + length <= bounds[text + 1]
    p, text, anchor = p[ok], text[ok], anchor[ok]
    if not len(p):
        return None
    new = np.ones(len(p), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:] - 1, len(p) - 1)
    return text[first], p[first], p[last], anchor[first], prints


def _anchors(length: int, ranks):
    """Rows (gram, run, doc_id, start, off, extent): one for each run of windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = ranks.value
        for batch in batches:
            data, offs = buffers(batch.column("text"))
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for i, j, a, b in _stretches(offs, length):
                if b - a < length:
                    continue
                d = data[a:b]
                bounds = np.clip(offs[i : j + 1] - a, 0, b - a)
                bounds[0] = 0
                got = runs_of(d, bounds, classes, length)
                if got is None:
                    continue
                text, lo, hi, anchor, prints = got
                # fingerprint of the run's bytes: prefix sums of fingerprints of its k-grams
                with np.errstate(over="ignore"):
                    sums = np.concatenate([np.zeros(1, U64), np.cumsum(prints * _odd(len(prints)))])
                    end = hi + length - K + 1
                    whole = mix((sums[end] - sums[lo]) * _odd_inverse(len(prints))[lo] + (hi - lo).astype(U64))
                start = lo + (a - offs[i + text])
                hot = classes[(prints[anchor] >> U64(64 - sketch.BITS)).astype(np.int64)] > 0
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(as_long(prints[anchor])),
                        pa.array(as_long(whole)),
                        pa.array(ids[i + text]),
                        pa.array(start.astype(np.int32)),
                        pa.array(((anchor - lo) * 256 + (hi - lo)).astype(np.int32)),
                        pa.array(hot),
                    ],
                    ["gram", "run", "doc_id", "start", "shape", "hot"],
                )

    return run


_ODD = U64(0xD1342543DE82EF95)
_odds: dict[str, np.ndarray] = {}


def _odd(n: int) -> np.ndarray:
    from wayweave.llm.bytetext import _powers

    if "up" not in _odds or len(_odds["up"]) < n:
        _odds["up"] = _powers(_ODD, max(n, PIECE * 2))
        _odds["down"] = _powers(U64(pow(int(_ODD), -1, 1 << 64)), max(n, PIECE * 2))
    return _odds["up"][:n]


def _odd_inverse(n: int) -> np.ndarray:
    _odd(n)
    return _odds["down"]


def _sorted_groups(length: int):
    """Rows (doc_id, start, stop) of repeated windows, from runs that come grouped by gram."""

    def flush(group: list[tuple]) -> list[tuple[int, int, int]]:
        if len(group) < 2:
            return []
        # (doc_id, start, off, extent, bytes)
        group.sort(key=lambda g: (g[0], g[1] + g[2]))
        left = [g[4][: g[2]][::-1] for g in group]
        right = [g[4][g[2] :] for g in group]
        out = []
        for i, least, most in repeated_windows(left, right, range(len(group)), length):
            doc, start, off, extent, _ = group[i]
            least = max(least, off - extent)
            if least <= most:
                at = start + off
                out.append((doc, at - most, at - least + length))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, group = None, []
        for batch in batches:
            rows: list[tuple[int, int, int]] = []
            for r in zip(*(batch.column(c).to_pylist() for c in ("gram", "doc_id", "start", "off", "extent", "bytes")), strict=True):
                if r[0] != gram:
                    rows += flush(group)
                    gram, group = r[0], []
                group.append(r[1:])
            if rows:
                yield _intervals(rows)
        if rows := flush(group):
            yield _intervals(rows)

    return run


def _intervals(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    doc, start, stop = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(doc, pa.int64()), pa.array(start, pa.int32()), pa.array(stop, pa.int32())], ["doc_id", "start", "stop"]
    )


def merged(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals, in order; touching ones become one."""
    if not len(start):
        return start, stop
    order = np.argsort(start, kind="stable")
    start, stop = start[order], np.maximum.accumulate(stop[order])
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > stop[:-1]
    first = np.flatnonzero(new)
    return start[first], stop[np.append(first[1:] - 1, len(start) - 1)]


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = [], []
        for x, y in zip(batch.column("starts"), batch.column("stops"), strict=True):
            s, e = merged(x.values.to_numpy(), y.values.to_numpy())
            a.append(s)
            b.append(e)
        kind = pa.list_(pa.int32())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(a, kind), pa.array(b, kind)], ["doc_id", "starts", "stops"])


def _cut(with_text: bool):
    """Rows (doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept])."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = buffers(batch.column("text"))
            size, gone, spans, sha, kept = [], [], [], [], []
            for k, (x, y) in enumerate(zip(batch.column("starts"), batch.column("stops"), strict=True)):
                d = data[offs[k] : offs[k + 1]]
                at, removed, digest, left = 0, 0, hashlib.sha256(), []
                s, e = ([], []) if not x.is_valid else (x.values.to_numpy().tolist(), y.values.to_numpy().tolist())
                for a, b in [*zip(s, e, strict=True), (len(d), len(d))]:
                    digest.update(d[at:a].tobytes())
                    if with_text:
                        left.append(d[at:a].tobytes())
                    removed += b - a
                    at = b
                size.append(len(d))
                gone.append(removed)
                spans.append(len(s))
                sha.append(digest.hexdigest())
                kept.append(b"".join(left))
            cols = [batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()), pa.array(sha)]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_text:
                cols.append(pa.array(kept, pa.binary()))
                names.append("kept")
            yield pa.RecordBatch.from_arrays(cols, names)

    return run


# ---------------------------------------------------------------- the operator


def repeated_spans(docs: DataFrame, ws: Workspace, length: int = 100, many: int = 200) -> DataFrame:
    """(doc_id, starts, stops): the covered byte ranges of each document that has any."""
    spark = docs.sparkSession
    counts = sketch.total(docs.select("text").mapInArrow(_count(length), sketch.SCHEMA))
    ranks = spark.sparkContext.broadcast(sketch.classes(counts))  # 1 MB whatever the input
    runs = docs.mapInArrow(_anchors(length, ranks), "gram long, run long, doc_id long, start int, shape int, hot boolean")
    runs = runs.withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("doc_id"), F.lit(HOT_SALTS))).otherwise(0).cast("int"))
    inside = Window.partitionBy("gram", "salt").orderBy("run", "doc_id", "start")
    ends = inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    shared = (
        runs.withColumns({"before": F.lag("run").over(inside), "rows": F.count("*").over(ends)})
        .filter((F.col("rows") > 1) | F.col("hot"))
        .select("gram", "run", "doc_id", "start", "shape", (F.coalesce(F.col("before") == F.col("run"), F.lit(False))).alias("later"))
    )
    shared = ws.save(shared, "shared")
    extent = F.col("shape") % 256
    whole = lambda df: df.select("doc_id", "start", (F.col("start") + extent + length).alias("stop"))

    # what the salts left of each run meets here
    inside = Window.partitionBy("gram").orderBy("run", "doc_id", "start")
    ends = inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = (
        shared.filter("NOT later").withColumns({"before": F.lag("run").over(inside), "least": F.first("run").over(ends), "most": F.last("run").over(ends), "rows": F.count("*").over(ends)})
        .withColumn("later", F.coalesce(F.col("before") == F.col("run"), F.lit(False)))
        .filter(F.col("later") | (F.col("least") != F.col("most")))
    )
    firsts = ws.save(firsts, "firsts")
    unlike = firsts.filter("NOT later")
    per_doc = unlike.groupBy("doc_id").agg(
        F.collect_list(F.struct("gram", "start", (F.col("shape").cast("int") / 256).cast("int").alias("off"), extent.alias("extent"), "rows")).alias("wanted")
    )
    strings = (
        docs.join(per_doc, "doc_id")
        .select("doc_id", "text", F.explode("wanted").alias("r"))
        .select("doc_id", "r.*", F.substring("text", F.col("r.start") + 1, F.col("r.extent") + length).alias("bytes"))
    )
    strings = ws.save(strings, "strings")
    few = (
        strings.filter(F.col("rows") <= many)
        .select("gram", "doc_id", "start", "off", "extent", "bytes")
        .repartition("gram")
        .sortWithinPartitions("gram")
        .mapInArrow(_sorted_groups(length), "doc_id long, start int, stop int")
    )
    windows = (
        strings.filter(F.col("rows") > many)
        .select("doc_id", "start", "bytes", F.explode(F.sequence(F.lit(0), F.col("extent"))).alias("i"))
        .select("doc_id", (F.col("start") + F.col("i")).alias("start"), F.substring("bytes", F.col("i") + 1, F.lit(length)).alias("window"))
    )
    first = windows.groupBy("window").agg(F.min(F.struct("doc_id", "start")).alias("first"), F.count("*").alias("n")).filter("n > 1")
    rest = windows.join(first, "window").filter(F.struct("doc_id", "start") != F.col("first")).select("doc_id", "start", (F.col("start") + length).alias("stop"))
    spans = whole(shared.filter("later")).union(whole(firsts.filter("later"))).union(few).union(rest)
    return (
        spans.groupBy("doc_id")
        .agg(F.collect_list("start").alias("starts"), F.collect_list("stop").alias("stops"))
        .mapInArrow(_merge, "doc_id long, starts array<int>, stops array<int>")
    )


def remove_repeats(
    docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False
) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept, the bytes).

    Texts are UTF-8 bytes, null is empty; strings never cross documents. A byte goes if a string
    of ``length`` bytes that covers it also starts earlier: in a smaller doc_id, or earlier in
    the same document. Strings may overlap and are judged on the input. Rows that repeat a
    doc_id and its text are one document, and each shows its result; a null id counts as the
    smallest. An empty table gives no rows; other columns are ignored. ``length`` is at least
    ``2 * K``. Runs are compared by two 64-bit fingerprints, all else by bytes.
    """
    if not 2 * K <= length <= 256:
        raise ValueError(f"length must be from {2 * K} to 256")
    ws = Workspace(docs.sparkSession, "suffix-dedup")
    small_batches(docs.sparkSession)
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc_id"),
        F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"),
    )
    repeats = rows.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").limit(1).count()
    single = rows.dropDuplicates(["doc_id"]) if repeats else rows
    spans = ws.save(repeated_spans(single, ws, length), "spans")
    ws.drop("shared", "firsts", "strings")
    few = (spans.agg(F.sum(F.size("starts"))).first()[0] or 0) <= BROADCAST_ROWS
    cut = rows.join(F.broadcast(spans) if few else spans, "doc_id", "left").select("doc_id", "text", "starts", "stops")
    shape = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    return cut.mapInArrow(_cut(with_text), shape).withColumn("doc_id", F.nullif("doc_id", F.lit(NO_ID)))

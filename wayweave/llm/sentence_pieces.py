"""SentencePiece encoding and decoding with N-best segmentations.

A text's piece lattice has a node at each byte and an edge for each piece that spells the bytes
between two nodes; a byte that is no piece by itself has an edge of its own (byte fallback). No
piece holds a space after another character, so the lattice falls apart at the beginning of each
run of spaces into units, and the forward Viterbi pass runs over the distinct units of a batch
at once, step by step.

The N best segmentations come from a backward A* search: partial paths grow from the end of the
text towards its beginning, and the forward Viterbi score of the node they have reached is the
exact score of the best way to complete them, so complete paths leave the queue in order of
score. A unit's second-best path tells how much leaving its best path costs at least; the N best
of a text leave it only in the N - 1 units where that is cheapest, so the search runs over those
units' lattices, joined, with the rest of the text at its best.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayweave.llm.bytetext import PIECE, U64, buffers, mix, pieces, powers
from wayweave.plans.workspace import small_batches

LOW = -1e18
TABLE_BITS = 20
HEAD_BITS = 18
MARK = "▁"  # the vocabulary's sign for a space


@dataclass
class Vocabulary:
    """Pieces by hash of their bytes."""

    spelled: list[bytes]
    score: np.ndarray
    byte_id: np.ndarray
    byte_score: float
    lengths: list[int]
    slot: np.ndarray
    prints: np.ndarray
    begins: np.ndarray
    cache: UnitCache | None = None


def _print(piece: bytes) -> int:
    d = np.frombuffer(piece, np.uint8)
    up, _ = powers(len(d) + 1)
    with np.errstate(over="ignore"):
        return int(mix(np.array([((d.astype(U64) + U64(1)) * up[: len(d)]).sum(dtype=U64) + U64(len(d))], U64))[0])


def _head(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Place of three bytes in the table of the lengths of pieces that may begin with them."""
    return ((a.astype(np.uint32) << np.uint32(16) | b.astype(np.uint32) << np.uint32(8) | c) * np.uint32(2654435761)) >> np.uint32(32 - HEAD_BITS)


def vocabulary(pieces_: list[tuple[str, float, str]]) -> Vocabulary:
    """From (piece, score, kind), kind one of normal, byte, other; other pieces spell nothing."""
    spelled, score = [], np.full(len(pieces_), LOW)
    byte_id = np.full(256, -1, np.int64)
    for i, (text, s, kind) in enumerate(pieces_):
        if kind == "normal":
            b = text.replace(MARK, " ").encode()
            if b" " in b.lstrip(b" "):
                raise ValueError("a piece holds a space after another character")
            spelled.append(b)
            score[i] = s
        elif kind == "byte":
            byte_id[int(text[1:-1], 16)] = i
            spelled.append(bytes([int(text[1:-1], 16)]))
        else:
            spelled.append(b"")
    if (byte_id < 0).any():
        raise ValueError("the vocabulary lacks byte pieces")
    # placeholders of the vocabulary have huge negative scores; they, too, spell their bytes
    usual = score[score > -1e8]
    byte_score = float(usual.min()) * 2 - 10 if len(usual) else -10.0
    score = np.where((score > LOW) & (score < byte_score), byte_score / 2, score)
    slot = np.full(1 << TABLE_BITS, -1, np.int32)
    prints = np.zeros(len(spelled), U64)
    for i in np.flatnonzero(score > LOW):
        h = _print(spelled[i])
        prints[i] = h
        at = h >> (64 - TABLE_BITS)
        while slot[at] >= 0:
            at = (at + 1) & ((1 << TABLE_BITS) - 1)
        slot[at] = i
    lengths = sorted({len(spelled[i]) for i in np.flatnonzero(score > LOW)})
    begins = np.zeros(1 << HEAD_BITS, U64)
    long = [spelled[i] for i in np.flatnonzero(score > LOW) if len(spelled[i]) >= 3]
    if long:
        firsts = np.frombuffer(b"".join(b[:3] for b in long), np.uint8).reshape(-1, 3)
        np.bitwise_or.at(begins, _head(*firsts.T), np.array([1 << min(len(b), 63) for b in long], U64))
    return Vocabulary(spelled, score, byte_id, byte_score, lengths, slot, prints, begins)


def load(path: str) -> Vocabulary:
    """Read a SentencePiece model file."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    kind = lambda i: "byte" if m.is_byte(i) else "other" if m.is_control(i) or m.is_unknown(i) or m.is_unused(i) else "normal"
    return vocabulary([(m.id_to_piece(i), m.get_score(i), kind(i)) for i in range(m.get_piece_size())])


def _find(v: Vocabulary, h: np.ndarray) -> np.ndarray:
    """Piece of each fingerprint, -1 for none."""
    at = (h >> U64(64 - TABLE_BITS)).astype(np.int64)
    out = np.full(len(h), -1, np.int64)
    live = np.arange(len(h))
    while len(live):
        got = v.slot[at[live]]
        live, got = live[got >= 0], got[got >= 0]
        hit = v.prints[got] == h[live]
        out[live[hit]] = got[hit]
        live = live[~hit]
        at[live] = (at[live] + 1) & ((1 << TABLE_BITS) - 1)
    return out


@dataclass
class Lattices:
    """Lattices of units of like length, padded to one length, with their Viterbi scores.

    piece[t, k - 1, u] is the piece of k bytes that begins at byte t of unit u, -1 for none.
    forward[t, u] is the best score of bytes 0..t, via[t, u] the length of its last piece, gap
    how far the unit's second best path stands behind; without ``whole`` there are pieces and forward scores only.
    """

    size: np.ndarray
    piece: np.ndarray
    score: np.ndarray
    forward: np.ndarray
    via: np.ndarray | None = None
    gap: np.ndarray | None = None

    def best(self) -> tuple[np.ndarray, np.ndarray]:
        """(pieces in order, their number by unit) of the best paths."""
        at = self.size.astype(np.int64)
        live = np.flatnonzero(at > 0)
        who, what = [], []
        while len(live):
            k = self.via[at[live], live].astype(np.int64)
            at[live] -= k
            who.append(live)
            what.append(self.piece[at[live], k - 1, live])
            live = live[at[live] > 0]
        if not who:
            return np.zeros(0, np.int64), np.zeros(len(self.size), np.int64)
        units = np.concatenate(who[::-1])
        order = np.argsort(units, kind="stable")
        return np.concatenate(what[::-1])[order].astype(np.int64), np.bincount(units, minlength=len(self.size))

    def edges(self, u: int) -> tuple[list[float], list[list[tuple[int, float, int]]]]:
        """Forward scores of a unit's nodes, and by end node its edges (begin, score, piece)."""
        n = int(self.size[u])
        into: list[list[tuple[int, float, int]]] = [[] for _ in range(n + 1)]
        ids = self.piece[:n, :, u].T
        k, t = np.nonzero(ids >= 0)
        for end, begin, s, i in zip((t + k + 1).tolist(), t.tolist(), self.score[t, k, u].tolist(), ids[k, t].tolist(), strict=True):
            into[end].append((begin, s, i))
        return self.forward[: n + 1, u].tolist(), into


def _edges(v: Vocabulary, d: np.ndarray, sums: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
    """Unit, begin, length, piece and score of all edges of the units."""
    unit = np.repeat(np.arange(len(size)), size)
    begin = np.arange(len(unit)) - np.repeat(np.cumsum(size) - size, size)
    at, left = start[unit] + begin, size[unit] - begin
    # only lengths that some piece with these three bytes has are looked up
    wide = np.flatnonzero(left >= 3)
    may = v.begins[_head(d[at[wide]], d[at[wide] + 1], d[at[wide] + 2])]
    wide, may = wide[may > 0], may[may > 0]
    nodes, ks = [], []
    for k in v.lengths:
        if k < 3:
            nodes.append(np.flatnonzero(left >= k))
        else:
            some = wide[(may >> U64(min(k, 63))) & U64(1) > 0]
            nodes.append(some[left[some] >= k])
        ks.append(np.full(len(nodes[-1]), k, np.int64))
    node, k = np.concatenate(nodes), np.concatenate(ks)
    b = at[node]
    _, down = powers(len(d) + 1)
    with np.errstate(over="ignore"):
        piece = _find(v, mix((sums[b + k] - sums[b]) * down[b] + k.astype(U64)))
    score = np.where(piece >= 0, v.score[piece], v.byte_score)
    piece = np.where((piece < 0) & (k == 1), v.byte_id[d[b]], piece)  # byte fallback where the byte is no piece
    hit = piece >= 0
    return unit[node[hit]], begin[node[hit]], k[hit], piece[hit], score[hit]


def lattices(v: Vocabulary, d: np.ndarray, sums: np.ndarray, start: np.ndarray, size: np.ndarray, whole: bool = True) -> Lattices:
    """Lattices of the units d[start:start + size]; sums are the prefix sums of d's fingerprints."""
    n, width = len(size), int(size.max(initial=0))
    unit, begin, k, ids, scores = _edges(v, d, sums, start, size)
    span = int(k.max(initial=1))
    piece = np.full((width, span, n), -1, np.int32)
    piece[begin, k - 1, unit] = ids
    # span rows before the first node, which no path comes from
    padded = np.full((span + width, span, n), LOW)
    score = padded[span:]
    score[begin, k - 1, unit] = scores
    rows, of_length, of_unit = padded.strides
    # ending[t, k - 1] is the score of the piece of k bytes that ends at node t
    ending = np.lib.stride_tricks.as_strided(padded[span - 1 :], (width + 1, span, n), (rows, of_length - rows, of_unit), writeable=False)
    reach = np.full((span + width + 1, n), LOW)
    reach[span] = 0.0
    forward = reach[span:]
    via = np.zeros((width + 1, n), np.int16)
    each = np.arange(n)
    for t in range(1, width + 1):
        s = reach[t : span + t][::-1] + ending[t]
        if whole:
            last = s.argmax(0)  # the shortest of equal ones
            via[t] = last + 1
            np.maximum(s[last, each], LOW, out=forward[t])
        else:
            np.maximum(s.max(0), LOW, out=forward[t])
    if not whole:
        return Lattices(size, piece, score, forward)
    back = np.full((width + 1 + span, n), LOW)
    back[size, each] = 0.0
    for t in range(width - 1, -1, -1):
        np.maximum(back[t], (back[t + 1 : t + 1 + span] + score[t]).max(0), out=back[t])
    # the best path that leaves the best one: over each edge off it, the best path through
    top = forward[size, each]
    on = np.zeros((width + 1, n), np.int16)  # by end node, the length of the best path's edge
    at = size.astype(np.int64)
    live = np.flatnonzero(at > 0)
    while len(live):
        last = via[at[live], live]
        on[at[live], live] = last
        at[live] -= last
        live = live[at[live] > 0]
    second = np.full(n, LOW)
    off = on[begin + k, unit] != k
    unit, begin, k = unit[off], begin[off], k[off]
    np.maximum.at(second, unit, forward[begin, unit] + scores[off] + back[begin + k, unit])
    gap = np.where(second > LOW / 2, top - second, np.inf)
    return Lattices(size, piece, score, forward, via, gap)


def a_star(units: list[tuple[list[float], list[list[tuple[int, float, int]]]]], count: int) -> list[tuple[float, list[list[int]]]]:
    """The ``count`` best joint segmentations of some units: (score, pieces of each unit).

    The queue holds partial paths from the end, ordered by their score plus the forward score of
    their first node and of all units before it, which is exact.
    """
    before = [0.0]
    for forward, _ in units:
        before.append(before[-1] + forward[-1])
    k = len(units) - 1
    tick = 0
    queue = [(-before[-1], 0, 0.0, k, len(units[k][0]) - 1, None)]
    out = []
    while queue and len(out) < count:
        _, _, done, k, node, path = heapq.heappop(queue)
        while node == 0 and k > 0:
            k -= 1
            node = len(units[k][0]) - 1
        if node == 0:
            split: list[list[int]] = [[] for _ in units]
            while path is not None:
                u, piece, path = path
                split[u].append(piece)
            out.append((done, split))
            continue
        forward, into = units[k]
        base = before[k]
        for begin, cost, piece in into[node]:
            if forward[begin] > LOW / 2:
                tick += 1
                score = done + cost
                heapq.heappush(queue, (-(score + forward[begin] + base), tick, score, k, begin, (k, piece, path)))
    return out


#: Units are padded to the next of these lengths, or to their own if longer.
WIDTHS = [4, 6, 8, 10, 12, 14, 16, 20, 24, 32, 48, 64]
#: Lattices are built for as many units at a time as fill this many nodes, or for one unit.
NODES = 1 << 16
#: Segmentations leave a task in batches of about so many piece ids.
IDS = 1 << 19


class Units:
    """Best paths and gaps of a set of distinct units or, where the lattices are kept, their edges on demand."""

    def __init__(self, v: Vocabulary, d: np.ndarray, sums: np.ndarray, start: np.ndarray, size: np.ndarray, keep: bool = True):
        n = len(size)
        self.top, self.gap = np.zeros(n), np.zeros(n)
        group = np.searchsorted(WIDTHS, size)
        wide = group == len(WIDTHS)
        group = np.where(wide, len(WIDTHS) + np.frexp(size / 64)[1], group)
        self.kept, self.row, self.of = [], np.zeros(n, np.int64), np.zeros(n, np.int64)
        ids, who = [], []
        alike = [np.flatnonzero(group == g) for g in np.unique(group)]
        steps = [max(1, NODES // (int(size[m].max()) + 1)) for m in alike]
        for mine in (m[i : i + step] for m, step in zip(alike, steps, strict=True) for i in range(0, len(m), step)):
            x = lattices(v, d, sums, start[mine], size[mine], whole=not keep)
            if keep:
                self.of[mine] = len(self.kept)
                self.kept.append(x)
                self.row[mine] = np.arange(len(mine))
                continue
            self.top[mine] = x.forward[x.size, np.arange(len(mine))]
            self.gap[mine] = x.gap
            got, many = x.best()
            ids.append(got)
            who.append(np.repeat(mine, many))
        units = np.concatenate(who) if who else np.zeros(0, np.int64)
        order = np.argsort(units, kind="stable")
        self.ids = np.concatenate(ids)[order] if ids else np.zeros(0, np.int64)
        self.cut = np.concatenate([[0], np.cumsum(np.bincount(units, minlength=n))])
        self.known: dict[int, tuple] = {}

    def edges(self, u: int) -> tuple:
        if u not in self.known:
            self.known[u] = self.kept[int(self.of[u])].edges(int(self.row[u]))
        return self.known[u]


class UnitCache:
    """Best paths of units seen before by this process, by fingerprint; emptied when it is full."""

    UNITS, PIECES = 500_000, 8_000_000

    def __init__(self) -> None:
        self.prints = np.zeros(0, U64)
        self.top, self.gap = np.zeros(0), np.zeros(0)
        self.start, self.many = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def find(self, prints: np.ndarray) -> np.ndarray:
        """Place of each fingerprint, -1 if it is not known."""
        if not len(self.prints):
            return np.full(len(prints), -1, np.int64)
        at = np.minimum(np.searchsorted(self.prints, prints), len(self.prints) - 1)
        return np.where(self.prints[at] == prints, at, -1)

    def add(self, prints: np.ndarray, x: Units) -> None:
        every = np.concatenate([self.prints, prints])
        order = np.argsort(every, kind="stable")
        self.prints = every[order]
        self.top = np.concatenate([self.top, x.top])[order]
        self.gap = np.concatenate([self.gap, x.gap])[order]
        self.start = np.concatenate([self.start, x.cut[:-1] + len(self.ids)])[order]
        self.many = np.concatenate([self.many, np.diff(x.cut)])[order]
        self.ids = np.concatenate([self.ids, x.ids.astype(np.int32)])


def _best_of(v: Vocabulary, d: np.ndarray, sums: np.ndarray, prints: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[UnitCache, np.ndarray]:
    """The cache with all these distinct units in it, and their places."""
    cache = v.cache
    if cache is None or len(cache.prints) > UnitCache.UNITS or len(cache.ids) > UnitCache.PIECES:
        cache = v.cache = UnitCache()
    new = np.flatnonzero(cache.find(prints) < 0)
    if len(new):
        cache.add(prints[new], Units(v, d, sums, start[new], size[new], keep=False))
    return cache, cache.find(prints)


def encode(v: Vocabulary, column: pa.Array, nbest: int) -> Iterator[list[tuple[float, np.ndarray]]]:
    """For each text, its ``nbest`` best segmentations as (score, piece ids); fewer if there are no more.

    A space is put before a text that has any byte, as the vocabulary's words begin with one.
    """
    data, offs = buffers(column)
    for i, j in pieces(offs, 2 * PIECE):
        size = np.diff(offs[i : j + 1])
        new = offs[i : j + 1] - offs[i] + np.concatenate([[0], np.cumsum(size > 0)])
        d = np.full(int(new[-1]), 0x20, np.uint8)
        own = np.ones(len(d), bool)
        own[new[:-1][size > 0]] = False
        d[own] = data[offs[i] : offs[j]]
        space = d == 0x20
        heads = space.copy()
        heads[1:] &= ~space[:-1]
        heads[new[:-1][size > 0]] = True
        start = np.flatnonzero(heads)
        length = np.diff(np.append(start, len(d)))
        up, down = powers(len(d) + 1)
        with np.errstate(over="ignore"):
            sums = np.concatenate([np.zeros(1, U64), np.cumsum((d.astype(U64) + U64(1)) * up[: len(d)])])
            h = mix((sums[start + length] - sums[start]) * down[start] + length.astype(U64))
        prints, where, which = np.unique(h, return_index=True, return_inverse=True)
        cache, place = _best_of(v, d, sums, prints, start[where], length[where])
        text_at = np.searchsorted(start, new)
        gap = cache.gap[place]
        chosen = []
        for t in range(j - i):
            mine = which[text_at[t] : text_at[t + 1]]
            k = min(nbest - 1, len(mine))
            cheap = np.sort(np.argpartition(gap[mine], k - 1)[:k]) if k > 0 else np.zeros(0, np.int64)
            chosen.append(cheap[np.isfinite(gap[mine[cheap]])] if k > 0 else cheap)
        picked = np.unique(np.concatenate([which[text_at[t] + c] for t, c in enumerate(chosen)])) if chosen else np.zeros(0, np.int64)
        open_units = Units(v, d, sums, start[where[picked]], length[where[picked]])
        for t, cheap in enumerate(chosen):
            mine = which[text_at[t] : text_at[t + 1]]
            at = place[mine]
            lens = cache.many[at]
            into = np.cumsum(lens) - lens
            best = cache.ids[np.repeat(cache.start[at] - into, lens) + np.arange(lens.sum())]
            top = cache.top[at]
            total = float(top.sum())
            out = [(total, best)]
            if len(cheap):
                units = [open_units.edges(u) for u in np.searchsorted(picked, mine[cheap]).tolist()]
                rest = total - float(top[cheap].sum())
                for score, split in a_star(units, nbest)[1:]:
                    parts, done = [], 0
                    for c, p in zip(cheap, split, strict=True):
                        parts += [best[done : into[c]], np.array(p, np.int32)]
                        done = into[c] + lens[c]
                    out.append((rest + score, np.concatenate([*parts, best[done:]])))
            yield out


def decode_ids(v: Vocabulary, ids: np.ndarray) -> bytes:
    """The text that the pieces spell, without the space put before it."""
    return b"".join(map(v.spelled.__getitem__, ids.tolist()))[1:]


def same_text(v: Vocabulary, ids: np.ndarray, best: np.ndarray) -> bool:
    """Whether two segmentations spell the same text; only what lies between their common ends is decoded."""
    n = min(len(ids), len(best))
    differ = np.flatnonzero(ids[:n] != best[:n])
    head = int(differ[0]) if len(differ) else n
    differ = np.flatnonzero(ids[len(ids) - n :] != best[len(best) - n :])
    tail = min(n - 1 - int(differ[-1]) if len(differ) else n, n - head)
    spelled = lambda x: b"".join(map(v.spelled.__getitem__, x[head : len(x) - tail].tolist()))
    return spelled(ids) == spelled(best)


def _segmentations(texts: Iterable[list[tuple[float, np.ndarray]]]) -> pa.Array:
    """array<struct(score, ids)> of each text's segmentations."""
    score, ids, ends, counts = [], [], [0], [0]
    for found in texts:
        for s, p in found:
            score.append(s)
            ids.append(p.astype(np.int32))
            ends.append(ends[-1] + len(p))
        counts.append(len(score))
    flat = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32))
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
    rows = pa.StructArray.from_arrays([pa.array(score, pa.float64()), lists], ["score", "ids"])
    return pa.ListArray.from_arrays(pa.array(counts, pa.int32()), rows)


def encoded(spark, text: Column, v: Vocabulary, nbest: int = 4) -> Column:
    """array<struct(score, ids)> of a text column, best first.

    Null and empty texts have one empty segmentation of score 0. Every text can be encoded, and
    every segmentation decodes to it exactly.
    """
    small_batches(spark)
    shared = spark.sparkContext.broadcast(v)

    @F.arrow_udf("array<struct<score:double,ids:array<int>>>")
    def run(column: pa.Array) -> pa.Array:
        return _segmentations(encode(shared.value, column, nbest))

    return run(F.coalesce(text, F.lit("")))


def decoded(spark, ids: Column, v: Vocabulary) -> Column:
    """The text of an array of piece ids; null ids give null."""
    shared = spark.sparkContext.broadcast(v)

    @F.arrow_udf("string")
    def run(column: pa.Array) -> pa.Array:
        return pa.array([None if x is None else decode_ids(shared.value, np.array(x, np.int64)).decode("utf-8", "replace") for x in map(lambda y: y.as_py(), column)], pa.string())

    return run(ids)


def encode_documents(docs: DataFrame, v: Vocabulary, nbest: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_pieces, score, nbest_scores, nbest_pieces, ids_crc32, exact, nbest.

    nbest is the array of segmentations, best first, as (score, ids). score and n_pieces are of
    the best segmentation, ids_crc32 is of its ids as little-endian 32-bit integers, exact tells that all ``nbest`` segmentations decode to the text. Null text
    counts as empty: no pieces, score 0. Repeated rows give a row each; an empty table gives no
    rows; other columns are ignored. A text is cut before blanks only, so one of many bytes
    without any takes time and memory for all of it at once.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(v)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        for batch in batches:
            data, offs = buffers(batch.column("text"))
            rows, held, first = [], 0, 0
            for t, found in enumerate(encode(shared.value, batch.column("text"), nbest)):
                text, best = data[offs[t] : offs[t + 1]].tobytes(), found[0][1]
                exact = decode_ids(shared.value, best) == text and all(same_text(shared.value, p, best) for _, p in found[1:])
                rows.append((found, zlib.crc32(best.astype("<i4").tobytes()), exact))
                held += sum(len(p) for _, p in found)
                if held >= IDS or t + 1 == batch.num_rows:
                    yield table(batch.column("doc_id").slice(first, len(rows)), rows)
                    rows, held, first = [], 0, t + 1

    def table(ids: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
        paths = [found for found, _, _ in rows]
        return pa.RecordBatch.from_arrays(
            [
                ids,
                pa.array([len(f[0][1]) for f in paths], pa.int64()),
                pa.array([f[0][0] for f in paths], pa.float64()),
                pa.array([[s for s, _ in f] for f in paths], pa.list_(pa.float64())),
                pa.array([[len(p) for _, p in f] for f in paths], pa.list_(pa.int64())),
                pa.array([c for _, c, _ in rows], pa.int64()),
                pa.array([e for _, _, e in rows], pa.bool_()),
                _segmentations(paths),
            ],
            ["doc_id", "n_pieces", "score", "nbest_scores", "nbest_pieces", "ids_crc32", "exact", "nbest"],
        )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"doc_id {kind}, n_pieces long, score double, nbest_scores array<double>, nbest_pieces array<long>, ids_crc32 long, exact boolean, nbest array<struct<score:double,ids:array<int>>>"
    )

"""Stretches of words that repeat themselves, found by block matching.

For a scale B (a power of two) a document is cut into aligned blocks of B words. The blocks are
keys, as sequences of word numbers, of an Aho-Corasick automaton, which finds every place of the
document where a block occurs. A run of period q, with B <= q < 2B, and of four periods or more
holds an aligned block that stands again q words on; so an occurrence B to 2B - 1 words after its
block is a seed, and each occurrence has one aligned block at such a distance. A seed is extended
both ways by comparing words that are its distance apart. Scales go upwards: a stretch whose
smallest period is less has been found before.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayweave.plans.workspace import small_batches

#: A run has this many words, and this many periods, at least.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Numbers in a key of the automaton.
KEY = 16


def numbered(words: list[bytes]) -> np.ndarray:
    """Each word's number; equal words have equal numbers."""
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))


def _gaps(ids: np.ndarray) -> np.ndarray:
    """Words back to the last place of each word; the length of the text where there is none."""
    order = np.argsort(ids, kind="stable")
    gap = np.full(len(ids), len(ids))
    same = np.flatnonzero(ids[order[1:]] == ids[order[:-1]])
    gap[order[same + 1]] = order[same + 1] - order[same]
    return gap


def _agree(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common beginning, looking twice as far each time."""
    done, step, n = 0, 16, min(len(a), len(b))
    a, b = a[:n], b[:n]
    while done < n:
        unlike = np.flatnonzero(a[done : done + step] != b[done : done + step])
        if len(unlike):
            return done + int(unlike[0])
        done, step = min(done + step, n), step * 2
    return n


def _stretches(gap: np.ndarray, block: int) -> Iterator[tuple[int, int]]:
    """Ranges that can hold a run of this scale: each word but the first period's repeats one just before."""
    edge = np.diff(np.concatenate([[0], gap < 2 * block, [0]]).astype(np.int8))
    starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    need = max(LEAST_WORDS - 1, 3 * block) if block == 1 else 3 * block
    for i in np.flatnonzero(stops - starts >= need):
        yield max(int(starts[i]) - 2 * block + 1, 0), int(stops[i])


class _Names:
    """Numbers of the pieces of 1, 2, 4 ... words that begin at each word; equal pieces, equal numbers."""

    def __init__(self, ids: np.ndarray):
        self.levels = [ids]

    def at(self, size: int) -> np.ndarray:
        while 1 << (len(self.levels) - 1) < size:
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            pair = last[:-half] * (int(last.max()) + 1) + last[half:]
            self.levels.append(np.unique(pair, return_inverse=True)[1])
        return self.levels[size.bit_length() - 1]


def _seeds(names: _Names, lo: int, hi: int, block: int) -> Iterator[tuple[int, int]]:
    """(block start, distance) of aligned blocks that stand again B to 2B - 1 words on.

    A key has KEY numbers at most, those of a larger block being of pieces of several words, and
    each shift of the pieces is searched: so no key has long borders, which the automaton would
    go through at each word.
    """
    piece = max(block // KEY, 1)
    ids = names.at(piece)[lo : hi - piece + 1].tolist()
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    kinds: dict[tuple[int, ...], int] = {}
    at: dict[int, int] = {}
    for b in range(-(-lo // block) * block, hi - block + 1, block):
        at[b] = kinds.setdefault(tuple(ids[b - lo : b - lo + block : piece]), len(kinds))
    for key, kind in kinds.items():
        automaton.add_word(key, kind)
    automaton.make_automaton()
    for shift in range(piece):
        for end, kind in automaton.iter(tuple(ids[shift::piece])):
            p = lo + shift + (end + 1) * piece - block
            b = (p - block) // block * block
            if at.get(b) == kind:
                yield b, p - b


def runs_of(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period.

    A run is a stretch with smallest period q that no neighbouring word extends, of at least
    four periods and six words. Time is that of log n searches over the n words.
    """
    n, found, block = len(ids), [], 1
    gap, names, reach = _gaps(ids), _Names(ids), np.zeros(len(ids) + 1, np.int64)
    while LEAST_PERIODS * block <= n:
        inside = np.maximum.accumulate(reach)  # how far runs of smaller scales go that begin here or before
        for lo, hi in _stretches(gap, block):
            if hi <= inside[lo]:
                continue
            past: dict[int, list[tuple[int, int]]] = {}
            for b, d in _seeds(names, lo, hi, block):
                stop, seen = b + d + block, past.setdefault(d, [])
                k = bisect.bisect_right(seen, (b, n))  # stretches of one distance have disjoint pairs
                if stop <= inside[b] or (k and stop <= seen[k - 1][1]):
                    continue
                left = _agree(ids[:b][::-1], ids[: b + d][::-1])
                right = _agree(ids[b + block : n - d], ids[stop:])
                start, size = b - left, stop + right - (b - left)
                seen.insert(k, (start, start + size))
                if size >= max(LEAST_WORDS, LEAST_PERIODS * d):
                    found.append((start, size, d))
                    reach[start] = max(reach[start], start + size)
        block *= 2
    return sorted(set(found), key=lambda r: (r[0], r[2]))


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Mask of the words that stay: a run keeps its first period, unless another run drops that."""
    keep = np.ones(n, bool)
    for start, size, period in runs:
        keep[start + period : start + size] = False
    return keep


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: its id, runs (start, length, period by start, then period) and collapsed.

    Words are cut at ASCII white space. collapsed is the text whose runs keep one period, joined
    by single spaces. Null, empty and blank texts have no runs and collapse to the empty text.
    Repeated rows and ids each give their row, a null id stays null, an empty table gives no
    rows, other columns are ignored. A text is worked on whole in one task, in some 200 bytes a
    word; there is no shuffle, so copies and hot sources cost no more than other rows.
    """
    small_batches(docs.sparkSession)
    kind = docs.select(F.col(id_col).alias("doc_id")).schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_runs, texts = [], []
            for text in batch.column(1).to_pylist():
                words = (text or b"").split()
                runs = runs_of(numbered(words))
                keep = kept_words(len(words), runs)
                all_runs.append([{"start": s, "length": k, "period": q} for s, k, q in runs])
                texts.append(b" ".join(w for w, k in zip(words, keep, strict=True) if k) if runs else b" ".join(words))
            shape = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(all_runs, shape), pa.array(texts, pa.binary())], ["doc_id", "runs", "collapsed"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    found = rows.mapInArrow(work, f"doc_id {kind}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed binary")
    return found.select("doc_id", "runs", F.col("collapsed").cast("string").alias("collapsed"))


def with_planted_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text) where one text in ten, by the CRC-32 of its id, ends in a repeated stretch.

    With g the crc divided by 10, n words, a = g % n and p = 1 + (n - a) // (3 + g % 8), word
    i >= a becomes word a + (i - a) % p. Words of a changed text are joined by single spaces; other
    texts and texts of null ids stay as they are.
    """
    small_batches(docs.sparkSession)
    kind = docs.select(F.col(id_col).alias("doc_id")).schema["doc_id"].dataType.simpleString()

    def planted(crc: int, text: bytes) -> bytes:
        words, g = text.split(), crc // 10
        n = len(words)
        if not n:
            return text
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        return b" ".join([*words[:a], *(words[a + (i - a) % p] for i in range(a, n))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for name, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                crc = 1 if name is None else zlib.crc32(name.encode())
                texts.append(planted(crc, text) if text and crc % 10 == 0 else text)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], ["doc_id", "text"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(id_col).cast("string").alias("name"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(work, f"doc_id {kind}, text binary").select("doc_id", F.col("text").cast("string").alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """Per row of ``find_runs``: n_runs, the greatest run (ties: smallest start, then period) and digests.

    runs_sha256 is over each run's ``start,length,period`` and a line feed, collapsed_sha256 over
    the collapsed text. Without runs the four figures are null and runs_sha256 is that of no bytes.
    """
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    order = lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))
    best: Column = F.array_min(F.transform("runs", order))
    told = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.array_join(F.transform("runs", line), "").alias("lines"), "collapsed")
    length = -F.col("best.less")
    return told.select(
        "doc_id", "n_runs", F.col("best.start").alias("start"), length.alias("length"), F.col("best.period").alias("period"),
        F.floor(length * 1000 / F.col("best.period")).cast("long").alias("exponent_milli"),
        sha(F.col("lines")).alias("runs_sha256"), sha(F.col("collapsed")).alias("collapsed_sha256"),
    )

"""Runs of words against brute force over every period."""

import hashlib
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from wayweave.llm import periodic_runs


def brute_runs(words):
    """Every maximal stretch of each period, kept where the period is the stretch's smallest."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i:
                size = j + q - i
                if size >= max(6, 4 * q) and (i, size) not in found:
                    found[i, size] = q
            i = j + 1
    return sorted(((s, k, q) for (s, k), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    dropped = {i for s, k, q in runs for i in range(s + q, s + k)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    text = "".join(f"{s},{k},{q}\n" for s, k, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *best, runs and 1000 * best[1] // best[2] or None, sha(text.encode()), sha(kept))


def test_runs_of_small_alphabets():
    rng = random.Random(1)
    for _ in range(3000):
        n, k = rng.randint(0, 60), rng.choice((1, 2, 2, 3, 5))
        seq = [rng.randrange(k) for _ in range(n)]
        assert periodic_runs.runs_of(np.array(seq, np.int64)) == brute_runs(seq), seq


def test_runs_of_built_texts():
    """Nested, neighbouring and overlapping repeats of many periods."""
    rng = random.Random(2)
    for _ in range(300):
        seq = []
        for _ in range(rng.randint(1, 4)):
            part = [rng.randrange(rng.choice((2, 4, 50))) for _ in range(rng.randint(1, 40))]
            seq += part * rng.randint(1, 7) + part[: rng.randint(0, len(part))]
            if rng.random() < 0.3:
                seq *= rng.randint(1, 5)
        seq = seq[:1500]
        assert periodic_runs.runs_of(np.array(seq, np.int64)) == brute_runs(seq)


def test_long_run_is_quick():
    n = 300_000
    ids = np.zeros(n, np.int64)
    assert periodic_runs.runs_of(ids) == [(0, n, 1)]
    block = np.random.default_rng(0).integers(0, 1000, 1000)
    assert periodic_runs.runs_of(np.tile(block, 100)) == [(0, 100_000, 1000)]


def test_query_rows_against_brute_force(spark, docs):
    rng = random.Random(3)
    extra = []
    for i in range(300):
        words = [rng.choice("abcdefgh") for _ in range(rng.randint(0, 80))]
        extra.append((1000 + i, rng.choice((" ", "\n ", "\t")).join(words)))
    more = spark.createDataFrame(extra, "doc_id long, text string")
    table = docs.select("doc_id", "text").unionAll(more).withColumns({c: F.lit(1) for c in ("runs", "collapsed", "name", "n_runs")})
    got = periodic_runs.run_digests(periodic_runs.find_runs(periodic_runs.with_planted_runs(table)))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    key = lambda r: tuple(str(x) for x in r)
    rows = [(r.doc_id, r.text) for r in table.collect() if len(r.text or "") < 20_000]
    long = {r.doc_id for r in table.filter("length(text) >= 20000").collect()}
    want = sorted((brute_row(*r) for r in rows), key=key)
    assert sorted((tuple(r) for r in got.collect() if r.doc_id not in long), key=key) == want
    assert any(r[1] for r in want) and got.count() == table.count()


def test_no_rows(spark, empty):
    assert periodic_runs.run_digests(periodic_runs.find_runs(periodic_runs.with_planted_runs(empty))).collect() == []

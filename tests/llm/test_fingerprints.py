"""Digests against a plain-Python form of the method, and neighbours against a sorted list."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest_rows import words
from pyspark.sql import functions as F

from wayweave.llm import bytetext, fingerprints
from wayweave.llm.fingerprints import BITS, FULL, HASHES, LEVELS, NEIGHBOURS, POPULAR, SLACK, WINDOW

MASK = (1 << 64) - 1


def level(window):
    mass = lambda c: round(c * math.log2(c) * (1 << 20))
    return min((mass(WINDOW) - sum(map(mass, Counter(window).values()))) * LEVELS // mass(WINDOW), LEVELS - 1)


def mixed(x):
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> shift)) * factor & MASK
    return x ^ (x >> 31)




def hashed(window):
    h = sum((b + 1) * pow(int(bytetext.BASE), k, 1 << 64) for k, b in enumerate(window)) + len(window) * 0xD6E8FEB86659FD93
    return mixed(h & MASK)


def brute_filters(text, rank):
    b = text.encode()
    n = len(b) - WINDOW + 1
    if not b:
        return []
    if n <= 0:
        found = [hashed(b)]
    else:
        ranks = [rank[level(b[i : i + WINDOW])] for i in range(n)]
        votes = Counter(min(range(i, min(i + NEIGHBOURS, n)), key=lambda k: (ranks[k], k)) for i in range(n))
        chosen = sorted(p for p in votes if votes[p] >= POPULAR) or [min(votes, key=lambda p: (-votes[p], p))]
        found = list(dict.fromkeys(hashed(b[p : p + WINDOW]) for p in chosen))
    chain = []
    for a in range(0, len(found), FULL):
        chain.append({(h >> (11 * k)) & (BITS - 1) for h in found[a : a + FULL] for k in range(HASHES)})
    return chain


def brute_alike(a, b):
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0

    def toward(x, y):
        def worth(f, g):
            most, chance = min(len(f), len(g)), len(f) * len(g) / BITS
            cut = chance + SLACK * (most - chance)
            return min(max((len(f & g) - cut) / (most - cut), 0), 1)

        return sum(len(f) * max(worth(f, g) for g in y) for f in x) / sum(map(len, x))

    return (toward(a, b) + toward(b, a)) / 2 if len(a) == len(b) else toward(*sorted((a, b), key=len))


def bits_of(filters):
    return [set(np.flatnonzero(row).tolist()) for row in np.unpackbits(filters, axis=1)]


def samples():
    rng = random.Random(8)
    out = ["", "short", "x" * 31, "x" * 32, "y" * 500, words(rng, 12), words(rng, 60), words(rng, 900), "ab" * 300, "日本語のテキスト" * 40]
    out += ["".join(rng.choice("abcdefghij \n0123456789") for _ in range(rng.randint(1, 700))) for _ in range(25)]
    return out


@pytest.mark.parametrize("piece", [bytetext.PIECE, 257])
def test_filters_are_the_method(monkeypatch, piece):
    """Also where texts are worked on in parts of a few hundred bytes."""
    monkeypatch.setattr(bytetext, "PIECE", piece)
    monkeypatch.setattr(bytetext.pieces, "__defaults__", (piece,))
    texts = samples()
    column = pa.array([None, *texts])
    counts = fingerprints.level_counts(column)
    want = Counter(level(t.encode()[i : i + WINDOW]) for t in texts for i in range(len(t.encode()) - WINDOW + 1))
    assert counts.tolist() == [want[v] for v in range(LEVELS)]
    rank = np.empty(LEVELS, np.int64)
    rank[np.argsort(counts, kind="stable")] = np.arange(LEVELS)
    got = fingerprints.fingerprints(column, fingerprints.Rarity(rank))
    plain = [brute_filters(t, rank) for t in texts]
    assert [bits_of(f) if len(f) else [] for f in got] == [[], *plain]
    for i in range(len(texts)):
        for k in range(i, len(texts), 3):
            assert math.isclose(fingerprints.alike(got[i + 1], got[k + 1]), brute_alike(plain[i], plain[k]), abs_tol=1e-12)


def test_edits_are_near_and_others_far():
    rng = random.Random(9)
    texts = [words(rng, rng.choice((60, 300, 3000)), ("ka", "lo", "mi", "ne", "su", "ta", "re", "vo", "dri", "quon", "ble", "hast")) for _ in range(60)]
    edited = [t[: len(t) - len(t) // 4] + texts[i - 1][: len(t) // 4] for i, t in enumerate(texts)]
    rarity = fingerprints.Rarity(np.argsort(np.argsort(fingerprints.level_counts(pa.array(texts)), kind="stable")))
    one, two = (fingerprints.fingerprints(pa.array(c), rarity) for c in (texts, edited))
    near = [fingerprints.alike(a, b) for a, b in zip(one, two, strict=True)]
    far = [fingerprints.alike(one[i], one[i - 2]) for i in range(len(one))]
    assert min(near) > 0.3 > 0.1 > max(far)


def test_rows_against_sorted_list(spark, docs):
    """Null and repeated ids, null and equal texts, clashing names; every text whole."""
    table = docs.withColumns({c: F.lit(1) for c in ("range", "guest", "h", "edited", "next_text")})
    rarity = fingerprints.fit_rarity(docs)
    got = fingerprints.compare_edited(table, rarity).collect()
    rows = table.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()
    rows = sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.h, r.text))
    want = []
    for i, r in enumerate(rows):
        after, k = rows[(i + 1) % len(rows)].text, len(r.text) // 4
        edited = r.text[: len(r.text) - k] + after[:k]
        prints = fingerprints.fingerprints(pa.array([r.text, edited, after]), rarity)
        near = [fingerprints.alike(prints[0], p) for p in prints[1:]]
        want.append((r.doc_id, len(r.text), hashlib.sha256(edited.encode()).hexdigest(), prints[0].tobytes().hex(), prints[1].tobytes().hex(), *near))
    order = lambda r: (r[0] is not None, r[0] or 0, r[2])
    assert sorted(map(tuple, got), key=order) == sorted(want, key=order)
    by = {}
    for r, t in zip(sorted(map(tuple, got), key=order), sorted(want, key=order), strict=True):
        by.setdefault(t[3], set()).add(r[3])
    assert all(len(v) == 1 for v in by.values())


def test_few_rows(spark, empty):
    shape = "doc_id long, text string"
    rarity = fingerprints.fit_rarity(empty)
    assert fingerprints.compare_edited(empty, rarity).collect() == []
    (only,) = fingerprints.compare_edited(spark.createDataFrame([(3, "abcdefgh")], shape), rarity).collect()
    assert (only.n_chars, only.edited_sha256) == (8, hashlib.sha256(b"abcdefab").hexdigest()) and only.near_next == 1.0
    same = spark.createDataFrame([(1, "one"), (1, "one"), (2, None)], shape)
    got = sorted((r.doc_id, r.near_edited, r.near_next) for r in fingerprints.compare_edited(same, rarity).collect())
    assert got == [(1, 1.0, 0.0), (1, 1.0, 1.0), (2, 1.0, 0.0)]

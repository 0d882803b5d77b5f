"""Each operator against a brute-force version on the awkward documents, and on empty tables."""

import hashlib
import itertools
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest_rows import rows
from pyspark.sql import functions as F

from wayweave.llm import decontamination, language_id, sentence_pieces, toxicity
from wayweave.llm.exact_dedup import drop_copies, exact_dedup
from wayweave.llm.license_scan import PHRASES, TEMPLATES, scan_licenses, tokens
from wayweave.llm.ngram_join import drop_near_copies, jaccard_components
from wayweave.llm.sharding import assign_shards, jump_hash
from wayweave.llm.suffix_dedup import deep_shallow_sort, remove_repeats
from wayweave.llm.url_filter import judge_urls

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ROWS = [(r[0], r[1]) for r in rows()]


def multiset(found):
    return Counter(tuple(r) for r in found)


def test_exact_dedup(docs, empty):
    groups = {}
    for i, t in ROWS:
        groups.setdefault((t or "").translate(LOW), []).append(i)
    want = Counter()
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(t.encode()).hexdigest()
        want.update((i, keep, len(ids), i == keep, sha) for i in ids)
    got = exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert multiset(got.collect()) == want
    assert exact_dedup(empty).count() == 0
    kept = drop_copies(docs)
    assert kept.columns == docs.columns
    assert {r[0] for r in kept.select("doc_id").collect()} == {max((i for i in ids if i is not None)) for ids in groups.values()}


def test_jaccard_components(docs, empty):
    sets = []
    for i, t in ROWS:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW))
        sets.append((i, {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()))
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(sets)), 2):
        p, q = sets[a][1], sets[b][1]
        if p and q and 100 * len(p & q) >= 75 * len(p | q) and find(a) != find(b):
            parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    want = Counter((i, len(s), least.get(find(k)) if s else i) for k, (i, s) in enumerate(sets))
    assert multiset(jaccard_components(docs).select("doc_id", "n_shingles", "component_id").collect()) == want
    assert jaccard_components(empty).count() == 0
    left = drop_near_copies(docs.filter("doc_id IS NOT NULL"))
    assert {r[0] for r in left.select("doc_id").collect()} == {i for (i, n, c) in want if i is not None and i == c}


def test_license_scan(docs, empty, spark):
    more = [(900, "Released under the MIT License.\nthe Apache license, version 2 and CC BY-NC; cc by nc"), (901, "All rights\nreserved"), (902, "All rights reserved."),
            (903, "filler " * 400 + "this work is licensed under the GNU General Public License version 3 " + "filler " * 300)]
    table = docs.select("doc_id", "text").unionAll(spark.createDataFrame(more, "doc_id long, text string"))
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    got = scan_licenses(table).collect()
    want = Counter()
    for i, t in ROWS + more:
        w = word.findall((t or "").translate(LOW))
        at = {k: [j for j in range(len(w)) if w[j : j + len(p.split())] == p.split()] for k, p in PHRASES.items()}
        every = sorted(x for v in at.values() for x in v)
        want[i, len(w), len(every), every[0] if every else None, every[-1] if every else None, ",".join(sorted(k for k in at if at[k]))] += 1
    assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == want
    by = {r.doc_id: r for r in got}
    assert by[900].labels == "apache-2,cc-by-nc,mit" and by[900].score == 1.0
    assert by[901].labels == "" and by[902].labels == "proprietary" and by[903].labels == "gpl-3"
    # the join loses no block: every line against every template
    for i, t in ROWS + more:
        for line in (t or "").translate(LOW).split("\n"):
            w = set(word.findall(line))
            for label, texts in TEMPLATES.items():
                for tokens_ in map(tokens, texts):
                    if len(line) < 500 and len(w & set(tokens_)) >= np.ceil(0.8 * len(tokens_) - 1e-9):
                        assert label in by[i].labels.split(","), (i, label)
    assert scan_licenses(empty).count() == 0


def plain_jump(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2.0**31 / ((key >> 33) + 1)))
    return b


def test_sharding(docs, empty):
    keys = np.array([0, 1, 7, 2**40, 2**60 - 1, 12345678901])
    for n in (1, 2, 8, 9, 100):
        assert jump_hash(keys, n).tolist() == [plain_jump(int(k), n) for k in keys]
    got = assign_shards(docs).collect()
    key = lambda i: int(hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()[:15], 16)
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), "key", plain_jump(key(i), 8), plain_jump(key(i), 9)) for i, t in ROWS)
    assert Counter((r.doc_id, r.size, r.text_crc32, r.law, r.shard, r.grown_shard) for r in got) == want
    slots = {}
    for r in got:
        assert r.grown_shard in (r.shard, 8)
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert assign_shards(empty).count() == 0


def brute_repeats(pairs, length=100):
    seen, out = set(), {}
    for i, t in sorted(pairs, key=lambda p: -1 if p[0] is None else p[0]):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            w = b[s : s + length]
            if w in seen:
                gone[s : s + length] = b"\x01" * length
            seen.add(w)
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def test_remove_repeats(docs, empty, spark):
    want = brute_repeats(list(dict(ROWS).items()))
    got = remove_repeats(docs).collect()
    assert Counter(tuple(r) for r in got) == Counter((i, *want[i]) for i, _ in ROWS)
    assert remove_repeats(empty).count() == 0
    # many texts that share an anchor in unlike surroundings
    import random

    rng = random.Random(4)
    shared = "".join(rng.choice("abcdefgh") for _ in range(110))
    many = [(i, "".join(rng.choice("pqrst") for _ in range(90)) + shared[: 100 + i % 11] + "".join(rng.choice("uvwx") for _ in range(90))) for i in range(60)]
    from wayweave.llm import suffix_dedup
    from wayweave.plans.workspace import Workspace

    table = spark.createDataFrame(many, "doc_id long, text string").select("doc_id", F.col("text").cast("binary").alias("text"))
    want = brute_repeats(many)
    for few in (3, 200):
        spans = suffix_dedup.repeated_spans(table, Workspace(spark, "test"), many=few).collect()
        assert {r.doc_id: sum(b - a for a, b in zip(r.starts, r.stops, strict=True)) for r in spans} == {i: w[1] for i, w in want.items() if w[1]}


def test_deep_shallow_sort():
    import random

    rng = random.Random(1)
    for _ in range(500):
        s = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(0, 12))]
        order, lcp = deep_shallow_sort(s, rng.choice([0, 1, 3]))
        assert sorted(order) == list(range(len(s))) and [s[i] for i in order] == sorted(s)
        assert all(s[a][:n] == s[b][:n] for a, b, n in zip(order, order[1:], lcp[1:], strict=False))


RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def test_url_filter(spark):
    urls = [None, "", "no scheme", "http://A.Example.org/es/x?y#z", "http://example.org", "https://b.com/de/1", "https://b.com/fr/", "ftp://x.net/q?a=1&b=2", "http://notorg/es/",
            "http://example.org/en/12", "http://example.org/en/2", "a://b://c/d", "http://h?x/y", "http://h#x/y", "http://com/de/", "http://com/de"] * 3
    table = spark.createDataFrame([(i, u, "h", "p") for i, u in enumerate(urls)], "page_id long, url string, host string, path string")
    got = {r.page_id: r for r in judge_urls(table, RULES).collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        _, sep, rest = (u or "").partition("://")
        host = re.split(r"[/?#]", rest)[0] if sep else ""
        path = re.split(r"[?#]", rest[len(host) :])[0] if sep else ""
        host = host.translate(LOW)
        fits = [(len(h) + len(p), v, h + p) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        _, verdict, rule = max(fits, default=(0, None, None))
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), u
        assert got[i].verdict == verdict if verdict else got[i].verdict in ("allow", "block")
        assert 0 <= got[i].score <= 1
    assert judge_urls(table.limit(0), RULES).count() == 0


def edits(item, region):
    prev = [0] * (len(region) + 1)
    for i in range(1, len(item) + 1):
        cur = [i] + [0] * len(region)
        for j in range(1, len(region) + 1):
            cur[j] = min(prev[j - 1] + (item[i - 1] != region[j - 1]), prev[j] + 1, cur[j - 1] + 1)
        prev = cur
    return min(prev)


def test_decontamination(docs, empty, spark):
    import random

    rng = random.Random(7)
    texts = [t for _, t in ROWS if t and 200 < len(t) < 3000][:8]
    items = [(k, t[40:200]) for k, t in enumerate(texts[:4])]
    worn = list(texts[4][30:230])
    for p in (20, 90, 150):
        worn[p] = "Q"
    far = list(texts[5][30:230])
    for p in range(5, 195, 8):
        far[p] = "q"
    items += [(10, "".join(worn)), (11, "".join(far)), (12, None), (13, "  ?! "), (14, "ONE two"), (15, "never seen in any of these texts, not even roughly so")]
    bench = spark.createDataFrame([(i, t, 5) for i, t in items], "item_id long, text string, doc_id long")
    got = {(r.doc_id, r.item_id): r for r in decontamination.find_items(docs, bench).collect()}
    short = [(i, t) for i, t in ROWS if t and len(t) < 3000]
    for i, t in short:
        p = decontamination.plain(t)
        for k, x in items:
            q = decontamination.plain(x)
            if len(q) >= decontamination.Q:
                e = min(int(len(q) * 0.06), (len(q) - decontamination.Q) // decontamination.Q)
                d = edits(q, p) if rng.random() < 0.25 or (i, k) in got else None
                if d is not None:
                    assert ((i, k) in got) == (d <= e), (i, k, d, e)
                    assert (i, k) not in got or got[i, k].edits == d
    assert {i for i, k in got if k == 14} == {403, 404, 405}
    assert not {k for _, k in got} & {12, 13, 15}
    clean = decontamination.drop_contaminated(docs, bench)
    assert clean.columns == docs.columns
    assert {r[0] for r in clean.select("doc_id").collect()} == {i for i, _ in ROWS} - {i for i, _ in got}
    assert decontamination.find_items(empty, bench).count() == 0
    assert decontamination.find_items(docs, bench.limit(0)).count() == 0
    a = decontamination.align
    for _ in range(300):
        item, region = (bytes(rng.choice(b"abc") for _ in range(rng.randint(lo, 14))) for lo in (1, 0))
        limit = rng.randint(0, 4)
        d, found = edits(item, region), a(item, region, limit)
        assert found is None if d > limit else len(region) - len(item) < -limit or found[0] == d


def test_language_id(docs, empty, spark):
    model = language_id.fit(docs.filter("lang IS NOT NULL"), per_lang=120, clusters=2)
    got = docs.select("doc_id", "text", language_id.identify(spark, F.col("text"), model).alias("f")).select("doc_id", "text", "f.*").collect()
    assert len(got) == len(ROWS)
    for r in got:
        letters = any(c.isalpha() for c in r.text or "")
        assert 0 <= r.score <= 1 and (r.lang in ("en", "fr") if letters else r.lang == "und" and r.rejected)
    none = language_id.fit(empty)
    assert {r[0] for r in docs.select(language_id.identify(spark, F.col("text"), none)["lang"]).collect()} == {"und"}


def test_language_held_out(spark):
    root = "/root/testdata/sf0.01/documents.parquet"
    docs = spark.read.parquet(root)
    kept = language_id.held_out(F.col("doc_id"))
    model = language_id.fit(docs.filter(~kept))
    got = docs.filter(kept).select("lang", language_id.identify(spark, F.col("text"), model)["lang"].alias("p")).collect()
    assert sum(r.lang == r.p for r in got) >= 0.97 * len(got)


def test_toxicity(docs, empty, spark):
    labels = spark.createDataFrame([(i, 1, None if i == 3 else int(i % 2)) for i in range(12)] + [(9999, 0, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    got = [r[0] for r in docs.select(toxicity.toxicity(spark, F.col("text"), model)).collect()]
    assert len(got) == len(ROWS) and all(0 <= s <= 1 for s in got)
    flat = toxicity.fit(empty, labels.limit(0))
    assert all(0 <= r[0] <= 1 for r in docs.select(toxicity.toxicity(spark, F.col("text"), flat)).collect())


def test_toxicity_pairs():
    # each word alone says nothing, the pair does
    rng = np.random.default_rng(3)
    label, sets = [], []
    for _ in range(3000):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        sets.append(np.unique([1 if a else 2, 3 if b else 4, *rng.integers(10, 40, 3)]))
        label.append(float(a == b))
    m = toxicity.train_machine(np.array(label[:2000]), sets[:2000], 64, 0.5)
    assert len(m.weight) <= 64
    hit = 0
    for y, s in zip(label[2000:], sets[2000:], strict=True):
        row = m.slot[s]
        v = m.vector[row[row >= 0]]
        z = m.bias + m.weight[row[row >= 0]].sum() + 0.5 * (v.sum(0) ** 2 - (v**2).sum(0)).sum()
        hit += (z >= 0) == bool(y)
    assert hit >= 950


def test_toxicity_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    kept = language_id.held_out(F.col("doc_id"))
    model = toxicity.fit(docs, labels.filter(~kept))
    told = docs.join(labels.filter(kept), "doc_id")
    got = told.select("toxic", toxicity.toxicity(spark, F.col("text"), model).alias("s")).dropna().collect()
    toxic = [r.s >= 0.5 for r in got if r.toxic]
    assert sum(toxic) >= 0.8 * len(toxic)
    assert sum(r.s < 0.5 for r in got if not r.toxic) >= 0.995 * (len(got) - len(toxic))


def small_vocabulary():
    listed = [("<unk>", 0, "other")] + [(f"<0x{i:02X}>", 0, "byte") for i in range(256)]
    listed += [("▁", -5, "normal"), ("a", -3, "normal"), ("b", -3.5, "normal"), ("ab", -4, "normal"), ("▁a", -4.2, "normal"), ("ba", -4.1, "normal"), ("aba", -6, "normal"), ("▁▁", -5.5, "normal"), ("é", -7, "normal")]
    return sentence_pieces.vocabulary(listed)


def every_path(v, text):
    b = (" " + text).encode() if text else b""
    score = {s: v.score[i] for i, s in enumerate(v.spelled) if v.score[i] > -1e17}
    out = []

    def go(p, total):
        if p == len(b):
            out.append(total)
            return
        if b[p : p + 1] not in score:
            go(p + 1, total + v.byte_score)
        for q in range(p + 1, min(len(b), p + 4) + 1):
            if b[p:q] in score:
                go(q, total + score[b[p:q]])

    go(0, 0.0)
    return sorted(out, reverse=True)


def test_sentence_pieces(docs, empty, spark):
    import random

    v, rng = small_vocabulary(), random.Random(2)
    texts = ["", " ", "▁a"] + ["".join(rng.choice("ab  é\n") for _ in range(rng.randint(0, 8))) for _ in range(120)]
    for n in (1, 2, 5):
        for t, found in zip(texts, sentence_pieces.encode(v, pa.array(texts), n), strict=True):
            assert np.allclose([s for s, _ in found], every_path(v, t)[:n])
            assert len({tuple(p) for _, p in found}) == len(found)
            assert all(sentence_pieces.decode_ids(v, p) == t.encode() for _, p in found)
    got = sentence_pieces.encode_documents(docs, v).collect()
    assert len(got) == len(ROWS) and all(r.exact for r in got)
    assert all(list(r.nbest_scores) == sorted(r.nbest_scores, reverse=True) for r in got)
    back = docs.select("text", sentence_pieces.encoded(spark, F.col("text"), v, 2)[0]["ids"].alias("ids")).select("text", sentence_pieces.decoded(spark, F.col("ids"), v).alias("t"))
    assert all((r.text or "") == r.t for r in back.collect())
    assert sentence_pieces.encode_documents(empty, v).count() == 0


@pytest.mark.skipif(not __import__("os").path.exists("/opt/tokenizers/piece_bpe_32k.model"), reason="no vocabulary file")
def test_real_vocabulary(docs):
    v = sentence_pieces.load("/opt/tokenizers/piece_bpe_32k.model")
    assert all(r.exact for r in sentence_pieces.encode_documents(docs, v, 3).collect())

"""The pipeline's run() against brute force on a small folder of tables."""

import itertools
import random
import re

import numpy as np
import pyarrow as pa
from conftest_rows import rows, words
from pyspark.sql import functions as F
from test_operators import LOW, edits, small_vocabulary

import corpus_pipeline
from wayweave.llm import decontamination, language_id, sentence_pieces, toxicity


def best_scores(v, text, n):
    b = (" " + text).encode() if text else b""
    score = {s: v.score[i] for i, s in enumerate(v.spelled) if v.score[i] > -1e17}
    at = [[0.0]] + [[] for _ in b]
    for p in range(len(b)):
        at[p] = sorted(at[p], reverse=True)[:n]
        if b[p : p + 1] not in score:
            at[p + 1] += [t + v.byte_score for t in at[p]]
        for q in range(p + 1, min(len(b), p + 4) + 1):
            if b[p:q] in score:
                at[q] += [t + score[b[p:q]] for t in at[p]]
    return sorted(at[-1], reverse=True)[:n]


def check_nbest(v, text, found):
    assert np.allclose([r.score for r in found], best_scores(v, text, 4))
    assert len({tuple(r.ids) for r in found}) == len(found)
    for r in found:
        assert sentence_pieces.decode_ids(v, np.array(r.ids, np.int64)) == text.encode()
        assert np.isclose(sum(v.score[i] if v.score[i] > -1e17 else v.byte_score for i in r.ids), r.score)


def test_nbest_ids(docs):
    v, text = small_vocabulary(), {r[0]: r[1] or "" for r in rows()}
    for r in sentence_pieces.encode_documents(docs.filter("length(text) < 600"), v).collect():
        if r.doc_id is not None:
            check_nbest(v, text[r.doc_id], r.nbest)
        assert [len(x.ids) for x in r.nbest] == list(r.nbest_pieces) and [x.score for x in r.nbest] == list(r.nbest_scores)


def near_groups(kept):
    sets = {}
    for i, t in kept.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", t.translate(LOW))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in kept}
    for a, b in itertools.combinations(sorted(kept), 2):
        p, q = sets[a], sets[b]
        if p and q and 100 * len(p & q) >= 75 * len(p | q):
            lo, hi = sorted((root[a], root[b]))
            root = {i: lo if r == hi else r for i, r in root.items()}
    return root


def test_run(spark, tmp_path, monkeypatch):
    rng = random.Random(8)
    text = {r[0]: r[1] for r in rows() if r[0] is not None and len(r[1] or "") < 3000}
    text |= {1000 + i: words(rng, 20) + (" vile " if i % 2 else " ") + words(rng, 20) for i in range(80)}
    table = spark.createDataFrame(list(text.items()), "doc_id long, text string")
    table.write.parquet(f"{tmp_path}/documents.parquet")
    told = [(i, 1, int(i >= 1000 and i % 2)) for i in text]
    spark.createDataFrame(told, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    items = [(0, text[300][30:180]), (1, text[2][20:160]), (2, "never seen in any of these texts, not even roughly so")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    v = small_vocabulary()
    monkeypatch.setattr(corpus_pipeline, "load", lambda path: v)

    labels = spark.read.parquet(f"{tmp_path}/labels.parquet")
    m = toxicity.fit(spark.read.parquet(f"{tmp_path}/documents.parquet"), labels.filter(~language_id.held_out(F.col("doc_id"))))
    kept = {}
    for i, t in text.items():
        (_, _, bucket), = toxicity._terms(pa.array([t or ""]))
        slot = [k for k in m.slot[np.unique(bucket)] if k >= 0]
        z = m.bias + sum(m.weight[k] for k in slot) + sum(m.vector[a] @ m.vector[b] for a, b in itertools.combinations(slot, 2))
        if z < 0:
            kept[i] = t or ""
    assert {i for i in text if i not in kept} == {i for i in text if i >= 1000 and i % 2}
    last = {}
    for i, t in sorted(kept.items()):
        last[t.translate(LOW)] = i
    kept = {i: kept[i] for i in last.values()}
    kept = {i: kept[i] for i, r in near_groups(kept).items() if i == r}
    plain = {k: decontamination.plain(x) for k, x in items}
    clean = {}
    for i, t in kept.items():
        p = decontamination.plain(t)
        if all(edits(q, p) > min(int(len(q) * 0.06), (len(q) - decontamination.Q) // decontamination.Q) for q in plain.values()):
            clean[i] = t
    assert len(clean) < len(kept) < len(text) - 40

    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in got) == sorted(clean)
    for r in got:
        check_nbest(v, clean[r.doc_id], r.nbest)

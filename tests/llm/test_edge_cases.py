"""Clashing names, null and repeated ids, large groups of near copies, and models against plain formulas."""

import itertools
import random

import numpy as np
import pyarrow as pa
from conftest_rows import words
from pyspark.sql import functions as F
from test_pipeline import near_groups

from wayweave.llm import exact_dedup, language_id, ngram_join, toxicity, url_filter


def near(text, *at):
    w = text.split(" ")
    for i in at:
        w[i] = f"changed{i}"
    return " ".join(w)


def test_clashing_names(spark):
    base = words(random.Random(3), 60)
    rows = [(1, base), (2, base.upper()), (3, near(base, 30)), (4, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    extra = {c: F.lit(7) for c in ("text_sha256", "gone", "GONE_", "gone_id", "key", "cls", "component_id", "id")}
    docs = docs.withColumns(extra)
    got = exact_dedup.drop_copies(docs)
    assert got.columns == docs.columns and sorted(r.doc_id for r in got.collect()) == [2, 3, 5]
    got = ngram_join.drop_near_copies(docs)
    assert got.columns == docs.columns and sorted(r.doc_id for r in got.collect()) == [1, 4, 5]


def test_null_and_repeated_ids(spark):
    rng = random.Random(4)
    base, other, third = (words(rng, 60) for _ in range(3))
    rows = [(None, base), (4, near(base, 30)), (7, other), (7, third), (9, near(third, 5)), (None, words(rng, 40))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = ngram_join.jaccard_components(docs).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in got) == [(-1, -1), (-1, 4), (4, 4), (7, 7), (7, 7), (9, 7)]
    left = ngram_join.drop_near_copies(docs).collect()
    assert sorted((r.doc_id or -1) for r in left) == [-1, 4, 7, 7]


def test_large_near_group(spark):
    """Similarities on both sides of the bound, in two groups of unlike size that link with each other."""
    rng = random.Random(5)
    base = words(rng, 130)
    short = " ".join(base.split(" ")[:112])
    text = {}
    for i in range(160):
        of = base if i % 3 else short
        k = len(of.split(" "))
        text[i] = near(of, *rng.sample(range(k), rng.randint(0, 5)))
    docs = spark.createDataFrame(list(text.items()), "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.component_id for r in ngram_join.jaccard_components(docs).collect()}
    assert got == near_groups(text)


def test_machine_is_a_double_loop():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 40, 6)) for _ in range(300)]
    label = np.array([float(3 in s and 5 in s) for s in sets])
    m = toxicity.train_machine(label, sets, 64, label.mean())
    texts = ["", "one two three one", "é " * 50, "two"]
    m.slot[:] = np.arange(len(m.slot)) % len(m.weight)
    found = m.logits(pa.array(texts))
    for t, z in zip(texts, found, strict=True):
        bucket = np.concatenate([b for _, _, b in toxicity._terms(pa.array([t]))]) if t else np.zeros(0, np.int64)
        rows = sorted(set(m.slot[bucket].tolist()))
        want = m.bias + sum(m.weight[a] for a in rows) + sum(float(m.vector[a] @ m.vector[b]) for a, b in itertools.combinations(rows, 2))
        assert np.isclose(z, want)


def test_nearest_centroid_is_the_largest_cosine(spark):
    rng = random.Random(6)
    stems = {"aa": ("ka", "lo", "mi"), "bb": ("zu", "rex", "dop"), "cc": ("wy", "ghi", "qua")}
    rows = [(lang, words(rng, 30, s)) for lang, s in stems.items() for _ in range(40)]
    m = language_id.fit(spark.createDataFrame(rows, "lang string, text string"))
    far = "0x9 %% 77 jjjjjjj vvvvvv jjjjjj bbbbbbbbb ffffff"
    texts = [*[t for _, t in rows[::7]], far, "x"]
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    got = {r.i: r.x for r in table.select("i", language_id.identify(spark, F.col("text"), m).alias("x")).collect()}
    (tf,) = language_id.counts(pa.array(texts))
    for i, row in enumerate(tf):
        x = np.log1p(row) * m.idf
        norm = np.sqrt((x * x).sum())
        cosines = [float(x @ c) / max(norm, 1e-12) for c in m.points]
        assert np.isclose(got[i].score, min(max(max(cosines), 0.0), 1.0), atol=1e-5)
        assert np.isclose(max(cosines), max(c for c, lang in zip(cosines, m.langs, strict=True) if lang == got[i].lang), atol=1e-5)
    assert got[len(texts) - 2].rejected and not all(got[i].rejected for i in range(len(texts) - 2))


def test_too_many_languages_raise(spark):
    rows = spark.createDataFrame([("a", "one"), ("b", "two"), ("c", "three")], "lang string, text string")
    try:
        language_id.fit(rows, langs=2)
    except ValueError:
        return
    raise AssertionError("a third language was left out")


def test_first_of_equal_rules_holds(spark):
    rules = [("allow", "org", "/a"), ("block", "org", "/a")]
    pages = spark.createDataFrame([(1, "http://x.org/ab"), (2, "http://x.com/")], "page_id long, url string")
    got = {r.page_id: r for r in url_filter.judge_urls(pages, rules).collect()}
    assert (got[1].verdict, got[1].rule) == ("allow", "org/a") and got[2].rule is None


def test_a_shared_passage_is_few_columns(spark):
    """Documents with a passage in common, below the bound: the columns that the same classes share are one."""
    rng = random.Random(8)
    passage = words(rng, 300)
    text = {i: f"{words(rng, 120 + 5 * i)} {passage}" for i in range(8)}
    docs = spark.createDataFrame(list(text.items()), "doc_id long, text string").repartition(3)
    join = ngram_join.JaccardJoin(docs)
    join.profile()
    columns = join.columns()
    # sets of classes are nested, as a prefix ends somewhere in the passage: one more set for each class at most
    most, columns_of = columns.groupBy("cls").agg(F.count("*").alias("n"), F.sum("w").alias("w")).agg(F.max("n"), F.max("w")).first()
    assert most <= len(text) < 20 < columns_of
    assert columns.groupBy("u", "v", "cls").count().filter("count > 1").isEmpty()
    assert {r.doc_id: r.component_id for r in ngram_join.jaccard_components(docs).collect()} == near_groups(text)


def test_a_pair_meets_once(spark):
    """Near copies just below and above the bound share many columns of unlike rows; the product has one row a pair, not one a column."""
    rng = random.Random(4)
    base = words(rng, 200)
    text = {i: near(base, *[(60 * k + rng.randint(0, 50)) for k in range(3)]) for i in range(40)}
    docs = spark.createDataFrame(list(text.items()), "doc_id long, text string").repartition(3)
    join = ngram_join.JaccardJoin(docs)
    signs = join.profile().filter("n > 0").groupBy("cls").agg(*[F.max(s).alias(s) for s in ngram_join.SIGNS])
    columns = join.columns()
    none = columns.select(F.col("cls").alias("a"), F.col("cls").alias("b")).limit(0)
    pairs = join.second_round(columns, none, signs, none)
    made = join.meetings(spark.read.parquet(f"{join.ws.root}/cells"))
    assert 300 < pairs.count() <= 780 and made.count() <= 1.2 * pairs.count()
    # no pair that links is lost
    found = {(r.a, r.b) for r in pairs.collect()}
    cls = {r.doc_id: r.cls for r in join.profile().collect()}
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, w in ((i, t.split(" ")) for i, t in text.items())}
    linked = [(i, j) for i, j in itertools.combinations(text, 2) if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    assert linked and all(tuple(sorted((cls[i], cls[j]))) in found for i, j in linked if cls[i] != cls[j])
    assert {r.doc_id: r.component_id for r in ngram_join.jaccard_components(docs).collect()} == near_groups(text)

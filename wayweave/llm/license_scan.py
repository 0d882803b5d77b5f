"""License scan: phrase places, and an exact set-similarity join of text blocks with templates.

A block is a line, an overlapping window of a long line, or such a window over the words of all
lines, as notices are often wrapped. A template is found in a block when the block holds at least
``threshold`` of the template's distinct tokens; a template of at most ``SHORT`` tokens has to
stand in one line, as so few words meet by chance among those of many lines. Only tokens of the
template vocabulary can count, so blocks are reduced to those. Tokens are ordered by document
frequency over the whole corpus, rarest first; the join meets on prefix tokens only and then
applies the length and positional bounds before the exact overlap is taken. All filters are
lossless. DataFrame operations only.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayweave.plans.workspace import Workspace

#: Label and phrase, as words.
PHRASES: dict[str, str] = {
    "mit": "under the mit license",
    "apache-2": "apache license version 2",
    "cc-by-nc": "cc by nc",
}

#: Notices by label; each is a template of its own.
TEMPLATES: dict[str, list[str]] = {
    "apache-2": [
        "Licensed under the Apache License, Version 2.0",
        "you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted"],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International"],
    "gpl-3": ["This work is licensed under the GNU General Public License, version 3"],
    "mit": [
        "Released under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    ],
    "proprietary": ["All rights reserved"],
}

#: ASCII characters that separate words; letters and digits are apart from them, as is all above 0x7F.
SEPARATORS = "".join(chr(c) for c in [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
LINE_FEED = "\n"
#: Templates of so many distinct tokens or fewer are looked for in lines only.
SHORT = 3


def words_of(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    plain = F.translate(text, SEPARATORS + upper, " " * len(SEPARATORS) + upper.lower())
    return F.filter(F.split(plain, " "), lambda w: w != "")


def tokens(template: str) -> list[str]:
    """Distinct words of a template."""
    plain = "".join(" " if c in SEPARATORS else c for c in template)
    plain = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in plain)
    return list(dict.fromkeys(plain.split(" "))) if plain.strip(" ") else []


def places(words: Column, phrase: Sequence[str]) -> Column:
    """Word numbers, from 0, where the phrase's words stand consecutively."""
    wanted = F.array(*map(F.lit, phrase))
    joined = F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))
    starts = F.filter(
        F.sequence(F.lit(0), F.size(words) - 1),
        lambda i: (words[i] == phrase[0]) & (F.slice(words, i + 1, len(phrase)) == wanted),
    )
    none = F.array().cast("array<int>")
    return F.when(F.contains(joined, F.lit(f" {' '.join(phrase)} ")), starts).otherwise(none)


def windows_of(words: Column, width: int) -> Column:
    """The words as one array, or windows of ``2 * width`` every ``width`` if they are more."""
    n = F.size(words)
    return F.when(n <= 2 * width, F.array(words)).otherwise(
        F.transform(
            F.sequence(F.lit(1), F.greatest(n - width, F.lit(1)), F.lit(width)),
            lambda i: F.slice(words, i, 2 * width),
        )
    )


def blocks_of(text: Column, width: int) -> Column:
    """Word arrays: each line, and windows of ``2 * width`` words every ``width`` for longer ones."""
    return F.flatten(F.transform(F.split(text, LINE_FEED), lambda line: windows_of(words_of(line), width)))


def scan_licenses(
    docs: DataFrame,
    phrases: Mapping[str, str] = PHRASES,
    templates: Mapping[str, Sequence[str]] = TEMPLATES,
    threshold: float = 0.8,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score.

    n_base counts all places of all phrases; first_word and last_word are their smallest and
    largest start (null without one). labels adds the templates' labels. score is 1 with a
    phrase, else the best template containment, else 0. Null text counts as empty: no words, no
    labels. Repeated rows each get their row; rows are told apart by id and text, so a null or
    repeated id is safe. An empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    ws = Workspace(spark, "license-scan")
    index = [
        (label, toks) for label, texts in sorted(templates.items()) for t in texts if (toks := tokens(t))
    ]
    vocabulary = sorted({w for _, toks in index for w in toks})
    width = max((len(toks) for _, toks in index), default=1) * 2
    vocab = F.array(*map(F.lit, vocabulary)) if vocabulary else F.array().cast("array<string>")
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )

    # document frequency of each vocabulary token over the whole corpus; as many rows as tokens
    seen = dict(
        rows.select(F.explode(F.array_intersect(words_of(F.col("text")), vocab)).alias("token"))
        .groupBy("token")
        .agg(F.count("*").alias("n"))
        .collect()
    )
    rank = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (seen.get(w, 0), w)))}
    ordered = [(label, sorted(toks, key=rank.get)) for label, toks in index]
    needed = [math.ceil(threshold * len(toks) - 1e-9) for _, toks in ordered]
    prefix = sorted({w for (_, toks), a in zip(ordered, needed, strict=True) for w in toks[: len(toks) - a + 1]})
    lead = F.array(*map(F.lit, prefix)) if prefix else F.array().cast("array<string>")

    def met_blocks(blocks: Column) -> Column:
        return F.when(
            F.arrays_overlap("words", lead),
            F.transform(F.filter(blocks, lambda b: F.arrays_overlap(b, lead)), lambda b: F.array_intersect(b, vocab)),
        )

    words = F.col("words")
    found = {k: places(words, v.split(" ")) for k, v in phrases.items()}
    scanned = (
        rows.withColumn("words", words_of(F.col("text")))
        .withColumns({f"at_{i}": c for i, c in enumerate(found.values())})
        .select(
            "doc_id",
            F.xxhash64("text").alias("mark"),
            F.size("words").cast("long").alias("n_words"),
            F.flatten(F.array(*[F.col(f"at_{i}") for i in range(len(found))])).alias("starts"),
            F.filter(
                F.array(*[F.when(F.size(f"at_{i}") > 0, F.lit(k)) for i, k in enumerate(found)]),
                lambda x: x.isNotNull(),
            ).alias("base"),
            # prefix filter: a block without any template's prefix token meets no template
            met_blocks(blocks_of(F.col("text"), width)).alias("blocks"),
            F.when(F.contains("text", F.lit(LINE_FEED)), met_blocks(windows_of(F.col("words"), width))).alias("wrapped"),
        )
    )
    scanned = ws.save(scanned, "scanned")

    entries = [
        (t, label, len(toks), a, w, i, toks)
        for t, ((label, toks), a) in enumerate(zip(ordered, needed, strict=True))
        for i, w in enumerate(toks[: len(toks) - a + 1])
    ]
    shape = "tpl int, label string, t_size int, need int, token string, t_pos int, t_tokens array<string>"
    table = spark.createDataFrame(entries, shape)
    if len(entries) <= 10_000:  # beyond that Spark chooses the join
        table = F.broadcast(table)
    order = spark.createDataFrame(list(rank.items()), "token string, rank int")
    order = F.broadcast(order) if len(rank) <= 100_000 else order
    block = None
    for name, least in (("blocks", 0), ("wrapped", SHORT + 1)):
        some = scanned.filter(F.size(name) > 0).select(
            "doc_id", "mark", F.lit(least).alias("least"), F.explode(name).alias("b_tokens")
        )
        block = some if block is None else block.unionAll(some)
    met = (
        block.select("*", F.explode("b_tokens").alias("token"))
        .join(order, "token")
        .withColumns(
            {
                "b_size": F.size("b_tokens"),
            }
        )
        .join(table, "token")
        .filter((F.col("b_size") >= F.col("need")) & (F.col("t_size") >= F.col("least")))  # length
    )
    # position of the token in the block's frequency order: how many of its tokens are rarer
    ranks = F.create_map(*[x for w, i in rank.items() for x in (F.lit(w), F.lit(i))]) if rank else None
    if ranks is not None:
        met = met.withColumn(
            "b_pos", F.size(F.filter("b_tokens", lambda w: F.try_element_at(ranks, w) < F.col("rank")))
        )
    else:
        met = met.withColumn("b_pos", F.lit(0))
    rest = 1 + F.least(F.col("b_size") - F.col("b_pos"), F.col("t_size") - F.col("t_pos")) - 1
    overlap = F.size(F.array_intersect("b_tokens", "t_tokens"))
    hits = (
        met.filter((F.col("b_pos") <= F.col("b_size") - F.col("need")) & (rest >= F.col("need")))
        .withColumn("overlap", overlap)
        .filter(F.col("overlap") >= F.col("need"))
        .groupBy("doc_id", "mark")
        .agg(
            F.collect_set("label").alias("own"),  # at most as many as there are labels
            F.max(F.col("overlap") / F.col("t_size")).alias("best"),
        )
    )
    hits = hits.withColumnsRenamed({"doc_id": "hit_id", "mark": "hit_mark"})
    same = F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("mark") == F.col("hit_mark"))
    own = F.coalesce("own", F.array().cast("array<string>"))
    return scanned.join(hits, same, "left").select(
        "doc_id",
        "n_words",
        F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"),
        F.array_max("starts").cast("long").alias("last_word"),
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", own)), ",").alias("labels"),
        F.when(F.size("starts") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )

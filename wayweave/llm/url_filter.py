"""URL filter: host and path rules first, gradient-boosted trees on lexical features for the rest.

The trees are Spark ML's, over columns that SQL functions compute: lengths, depth, digit ratio,
character entropy, parameter counts and the labelled block rate of the host's last label and of
the path's first segment (suffix and prefix statistics).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayweave.llm.exact_dedup import ascii_lower
from wayweave.plans.workspace import Workspace

#: (verdict, host, path prefix)
Rule = tuple[str, str, str]

FEATURES = [
    "f_length", "f_host_length", "f_path_length", "f_labels", "f_depth", "f_digits",
    "f_entropy", "f_params", "f_fragment", "f_dashes", "f_suffix_rate", "f_segment_rate",
]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as struct(verdict, rule); null if none fits.

    Rules are a parameter list, so they travel inside the plan. Equal lengths: the first given.
    """
    best = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule_host, rule_path in sorted(reversed(rules), key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        named = F.struct(F.lit(verdict).alias("verdict"), F.lit(rule_host + rule_path).alias("rule"))
        best = F.when(fits, named).otherwise(best)
    return best


def entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits; 0 for the empty text."""
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    n = F.size(chars)

    def part(c: Column) -> Column:
        k = F.size(F.filter(chars, lambda x: x == c)).cast("double")
        return -(k / n) * F.log2(k / n)

    whole = F.aggregate(
        F.transform(F.array_distinct(chars), part), F.lit(0.0), lambda a, x: a + x
    )
    return F.when(n > 0, whole).otherwise(F.lit(0.0))


def lexical(pages: DataFrame) -> DataFrame:
    """Adds the lexical features to rows with url, host and path."""
    url = F.coalesce(F.col("url"), F.lit(""))
    count = lambda c, pattern: F.regexp_count(c, F.lit(pattern)).cast("double")
    return pages.withColumns(
        {
            "f_length": F.length(url).cast("double"),
            "f_host_length": F.length("host").cast("double"),
            "f_path_length": F.length("path").cast("double"),
            "f_labels": F.size(F.split("host", r"\.")).cast("double"),
            "f_depth": count(F.col("path"), "/"),
            "f_digits": count(url, "[0-9]") / F.greatest(F.length(url), F.lit(1)),
            "f_entropy": entropy(F.col("host")),
            "f_params": count(F.regexp_extract(url, r"(?s)\?([^#]*)", 1), "[^&=]+=?[^&]*"),
            "f_fragment": F.contains(url, F.lit("#")).cast("double"),
            "f_dashes": count(url, "[-_]"),
            "suffix": F.substring_index("host", ".", -1),
            "segment": F.regexp_extract("path", r"^/([^/]*)", 1),
        }
    )


def rates(labelled: DataFrame, key: str, name: str) -> DataFrame:
    """Smoothed block rate of each value of ``key`` among labelled urls of n rows each."""
    return (
        labelled.groupBy(key)
        .agg(F.sum("n").alias("n"), F.sum(F.col("label") * F.col("n")).alias("b"))
        .select(key, ((F.col("b") + 1.0) / (F.col("n") + 2.0)).alias(name), "n")
    )


def with_rates(df: DataFrame, common: DataFrame, rare: DataFrame | None, key: str, name: str) -> DataFrame:
    """Adds the rate of ``key``: common values by broadcast, ``rare`` ones (if any) by a join; else 0.5.

    Rows of common values meet nothing in the join, so they are spread over its partitions.
    """
    df = df.join(F.broadcast(common), key, "left")
    if rare is not None:
        spread = F.concat(F.lit("/"), F.monotonically_increasing_id().cast("string"))  # no value holds a slash
        df = df.withColumn("at", F.when(F.col(name).isNull(), F.col(key)).otherwise(spread))
        df = df.join(rare.select(F.col(key).alias("at"), F.col(name).alias("rare_rate")), "at", "left")
        df = df.withColumn(name, F.coalesce(name, "rare_rate")).drop("at", "rare_rate")
    return df.fillna(0.5, [name])


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    id_col: str = "page_id",
    url_col: str = "url",
    train_rows: int = 20_000,
    trees: int = 12,
    depth: int = 4,
    suffixes: int = 4_000,
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, score.

    A rule's verdict holds where one fits; elsewhere the trees' (score: probability of block,
    block from 0.5). They are fitted on distinct urls that a rule labels, at most ``train_rows`` of
    them, taken by hash of the url: of each label its share, but a twentieth of ``train_rows`` at
    least where it has so many, weighted back to its share. The rates of suffixes and segments
    are of all rows that a rule labels; a value without any has 0.5. With fewer than two kinds of label every other url is
    allowed (score 0). Null urls and urls without ``://`` have empty host and path, fit no rule
    and are judged by their (empty) features. Repeated rows and ids are kept. An empty table
    gives no rows; other columns are ignored. The rates of the ``suffixes`` commonest values are
    broadcast, those of rarer values are joined.
    """
    spark = pages.sparkSession
    ws = Workspace(spark, "url-filter")
    base = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    base = base.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    base = base.withColumn("fit", rule_for(F.col("host"), F.col("path"), rules))
    rows = lexical(base)
    label = (F.col("fit.verdict") == "block").cast("double").alias("label")
    known = base.filter(F.col("fit").isNotNull())
    known = ws.save(known.groupBy("url", "host", "path", label).agg(F.count("*").alias("n")), "known")
    known = lexical(known)
    parts = {}
    for key, name in (("suffix", "f_suffix_rate"), ("segment", "f_segment_rate")):
        every = ws.save(rates(known, key, name), name)
        common = ws.save(every.orderBy(F.desc("n"), key).limit(suffixes).drop("n"), f"{name}-common")
        more = every.count() > suffixes
        parts[key, name] = common, every.join(F.broadcast(common.select(key)), key, "left_anti") if more else None

    def featured(df: DataFrame) -> DataFrame:
        for (key, name), (common, rare) in parts.items():
            df = with_rates(df, common, rare, key, name)
        return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(df)

    urls = dict(known.groupBy("label").count().collect())  # two labels
    if len(urls) == 2:
        total = sum(urls.values())
        taken = {y: min(k, max(round(train_rows * k / total), train_rows // 20, 1)) for y, k in urls.items()}
        sample = None
        for y, k in sorted(taken.items()):
            some = known.filter(F.col("label") == y).orderBy(F.xxhash64("url"), "url").limit(k)
            some = some.withColumn("weight", F.lit(urls[y] / k * sum(taken.values()) / total))
            sample = some if sample is None else sample.unionAll(some)
        sample = ws.save(sample.drop("n", "url", "host", "path"), "sample").coalesce(1)
        model: GBTClassificationModel = GBTClassifier(
            maxIter=trees, maxDepth=depth, stepSize=0.3, seed=7, labelCol="label", weightCol="weight"
        ).fit(featured(sample))
        scored = model.transform(featured(rows)).withColumn(
            "score", vector_to_array("probability")[1]
        )
    else:
        scored = rows.withColumn("score", F.lit(0.0))
    own = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return scored.select(
        "page_id",
        "host",
        "path",
        F.col("fit.rule").alias("rule"),
        F.coalesce(F.col("fit.verdict"), own).alias("verdict"),
        F.col("score"),
    )

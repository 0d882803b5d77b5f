"""N-gram Jaccard join as a blocked sparse matrix product.

Documents are rows and word n-grams are columns of an incidence matrix; the overlap of two
documents is an entry of the matrix times its transpose. The columns are dealt into blocks by
fingerprint (the shuffle partitions). Only products that can matter are formed:

* rows with the same n-gram set are one row (a class), so copies cost nothing;
* prefix columns with the same rows are one column that counts as many times (its weight), so a
  passage that some rows share costs a few columns however long it is;
* a row takes part with its ``n - ceil(t n) + 1`` rarest columns, since two rows with similarity
  t or more share one of those; rare is judged by a sketch of all columns (any common order is
  lossless);
* pairs whose sizes, columns' positions, numbers of shared columns or signatures put the overlap
  below the bound are discarded.

The product runs in two rounds. First each column multiplies its rows with the ``HEADS`` among its
rows of like size that have the fewest rare columns. That is linear in the column's length and
the whole product of a short column. In a large group of near copies those rows have the fewest
changes; they lead all columns they are in, so their overlaps accumulate whole, and they link to more
rows than others would: the group falls together. Then columns that still hold rows of different components multiply those rows across
components, within the bounds, each pair at the first column it shares. Pairs inside one component are never listed, yet no link that
joins two components is lost. Overlaps of the pairs left are counted exactly over whole rows.

The signature of a row has, for each of ``WORDS * 64`` residues of its columns' fingerprints, the
parity of their number: two rows differ in at least as many columns as their signatures in bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayweave.llm import frequency_sketch as sketch
from wayweave.llm.bytetext import NOT_SPACE, U64, as_long, mix, shingles, word_pieces
from wayweave.operators.components import connected_components
from wayweave.plans.workspace import Workspace, free_name, small_batches

#: Rows to fetch are broadcast up to this number, 24 bytes each; beyond it they are joined by shuffle.
BROADCAST_IDS = 1_000_000
HOT_SALTS = 16
#: Rows of a column, in each of two bands of like size, that all its rows are multiplied with in the
#: first round. The bands overlap by half, so any two rows of sizes that can link share one of them.
HEADS = 8
#: Columns of a row that tell whether a pair has met before.
FIRSTS = 8
#: Parts of the columns, a power of two: the shuffle files of one part are on disk at a time, and each reads the texts anew.
PARTS = 2
#: Words of a signature.
WORDS = 8
SIGNS = [f"s{i}" for i in range(WORDS)]


def _sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct n-gram fingerprints of each text."""
    for i, j, h, at in word_pieces(column, NOT_SPACE):
        for k in range(j - i):
            yield np.unique(shingles(h[at[k] : at[k + 1]], size))


def _class(prints: np.ndarray) -> bytes:
    """96-bit fingerprint of a set."""
    with np.errstate(over="ignore"):
        one = mix(prints.copy()).sum(dtype=U64) ^ (prints * U64(0x9FB21C651E98DF25)).sum(dtype=U64)
        two = mix(prints ^ U64(0xA0761D6478BD642F)).sum(dtype=U64)
        return mix(np.array([one + U64(len(prints)), two], U64)).tobytes()[:12]


def _signature(prints: np.ndarray) -> np.ndarray:
    """Parities of the numbers of prints in each residue, as longs."""
    odd = np.bincount((prints >> U64(16)).astype(np.int64) & (WORDS * 64 - 1), minlength=WORDS * 64) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


_PROFILE = ["doc_id", "key", "n", "cls", *SIGNS, "slice", "part", "counts"]


def _profile(size: int):
    """Rows (doc_id, key, n, cls, signature of a class new to the task) and, at each task's end,
    the slices of its counters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, seen, part = sketch.Counter(), set(), 0
        for batch in batches:
            n, cls, signs, new = [], [], [], []
            for s in _sets(batch.column("text"), size):
                c = _class(s)
                n.append(len(s))
                cls.append(c)
                part = (part * 31 + int.from_bytes(c[:4], "little")) & 0x7FFFFFFFFFFF
                new.append(c not in seen)
                if new[-1]:
                    seen.add(c)
                    counter.add(s)
                signs.append(_signature(s) if new[-1] else np.zeros(WORDS, np.int64))
            k, old = len(n), ~np.array(new, bool)
            signs = np.stack(signs, 1) if k else np.zeros((WORDS, 0), np.int64)
            none = pa.nulls(k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("key"), pa.array(n, pa.int64()), pa.array(cls, pa.binary()),
                    *[pa.array(w, pa.int64(), mask=old) for w in signs],
                    none.cast(pa.int32()), none.cast(pa.int64()), none.cast(pa.binary()),
                ],
                _PROFILE,
            )
        if seen:
            rows = list(counter.slices())
            none = pa.nulls(len(rows), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    none, none, none, pa.nulls(len(rows), pa.binary()), *[none] * WORDS,
                    pa.array([r[0] for r in rows], pa.int32()), pa.array([part] * len(rows), pa.int64()), pa.array([r[1] for r in rows], pa.binary()),
                ],
                _PROFILE,
            )

    return run


def _prefixes(size: int, percent: int, ranks, part: int):
    """Rows (col, cls, n, pos, rare): the prefix columns of each class that are of the part, once a
    task; rare is how many of all of them the sketch doesn't set apart as common."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, seen = ranks.value, set()
        for batch in batches:
            cols, cls, n, pos, rare = [], [], [], [], []
            for s in _sets(batch.column("text"), size):
                if not len(s) or (c := _class(s)) in seen:
                    continue
                seen.add(c)
                keys = np.sort(sketch.order_key(s, table))
                k = len(s) - (percent * len(s) + 99) // 100 + 1
                at = np.flatnonzero(keys[:k] & U64(PARTS - 1) == U64(part))
                cols.append(keys[at])
                cls += [c] * len(at)
                n.append(np.full(len(at), len(s), np.int32))
                pos.append(at.astype(np.int32))
                rare.append(np.full(len(at), (keys[:k] < U64(1 << 56)).sum(), np.int32))
            if cols:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(as_long(np.concatenate(cols))), pa.array(cls, pa.binary()), *[pa.array(np.concatenate(x)) for x in (n, pos, rare)]],
                    ["col", "cls", "n", "pos", "rare"],
                )

    return run


def _of_class(size: int):
    """Rows (cls, text) whose text is of the class it was fetched for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [_class(s) for s in _sets(batch.column("text"), size)]
            same = [i for i, (c, want) in enumerate(zip(own, batch.column("cls").to_pylist(), strict=True)) if c == want]
            yield batch.select(["cls", "text"]).take(pa.array(same, pa.int64()))

    return run


def _overlaps(size: int):
    """Rows (a, b, overlap, na, nb) of pairs with both texts; overlaps are over whole sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, na, nb = [], [], []
            for p, q in zip(_sets(batch.column("text_a"), size), _sets(batch.column("text_b"), size), strict=True):
                both = np.concatenate([p, q])
                both.sort(kind="stable")
                out.append(int((both[1:] == both[:-1]).sum()))
                na.append(len(p))
                nb.append(len(q))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(out, pa.int64()), pa.array(na, pa.int64()), pa.array(nb, pa.int64())],
                ["a", "b", "overlap", "na", "nb"],
            )

    return run


class JaccardJoin:
    """The join over one table; ``components()`` runs it."""

    def __init__(self, docs: DataFrame, percent: int = 75, size: int = 5, id_col: str = "doc_id", text_col: str = "text"):
        self.docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
        self.docs = self.docs.withColumn("key", row_key(F.col("doc_id"), F.col("text")))
        self.percent, self.size = percent, size
        self.spark = docs.sparkSession
        self.ws = Workspace(self.spark, "ngram-join")
        small_batches(self.spark)

    def profile(self) -> DataFrame:
        """(doc_id, key, n, cls, signature) of every row; also gathers the sketch."""
        shape = f"doc_id long, key long, n long, cls binary, {', '.join(f'{s} long' for s in SIGNS)}, slice int, part long, counts binary"
        both = self.ws.save(self.docs.mapInArrow(_profile(self.size), shape), "profile")
        self.ranks = sketch.classes(sketch.total(both.filter("counts IS NOT NULL").select("slice", "part", "counts")))
        return both.filter("n IS NOT NULL").drop("slice", "part", "counts")

    def shared(self, ranks, part: int) -> DataFrame:
        """Prefix columns of one part that two classes or more share, those with the same classes as one."""
        cells = self.docs.select("text").mapInArrow(_prefixes(self.size, self.percent, ranks, part), "col long, cls binary, n int, pos int, rare int")
        hot = F.shiftrightunsigned("col", 56) > 0
        cells = cells.withColumn("salt", F.when(hot, F.pmod(F.xxhash64("cls"), F.lit(HOT_SALTS))).otherwise(0).cast("int"))
        by = Window.partitionBy("col", "salt").orderBy("n", "rare", "cls")
        whole = by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        # in this order a class that several tasks have met stands together, so one class alone has first = last
        shared = cells.withColumns({"first": F.first("cls").over(whole), "last": F.last("cls").over(whole), "before": F.lag("cls").over(by)})
        shared = shared.filter(((F.col("first") != F.col("last")) | hot) & ~F.col("before").eqNullSafe(F.col("cls")))
        # columns with the same rows have the same u and v; a hot one, whose rows are dealt over salts, stands for itself
        rows = Window.partitionBy("col", "salt")
        shared = shared.withColumns(
            {
                "u": F.when(hot, F.col("col")).otherwise(F.bit_xor(F.xxhash64("cls")).over(rows)),
                "v": F.when(hot, F.lit(0)).otherwise(F.bit_xor(F.xxhash64("cls", F.lit(1))).over(rows)),
            }
        )
        return self.merged(shared.withColumns({"w": F.lit(1).cast("long"), "hot": hot}))

    def merged(self, columns: DataFrame) -> DataFrame:
        """Columns with the same rows as one. All rows have the columns in one order, so the least positions are of one column."""
        return columns.groupBy("u", "v", "salt", "cls").agg(
            F.first("n").alias("n"), F.min("pos").alias("pos"), F.first("rare").alias("rare"), F.sum("w").alias("w"), F.max("hot").alias("hot")
        )

    def columns(self) -> DataFrame:
        """The shared columns of all parts, and the first classes of like size in each."""
        ranks = self.spark.sparkContext.broadcast(self.ranks)  # 1 MB whatever the input
        parts = []
        for i in range(PARTS):
            parts.append(self.ws.save(self.shared(ranks, i), f"part{i}"))
            self.ws.settle()
        # grouping and windows below all do with this one shuffle
        merged = self.merged(reduce(DataFrame.unionByName, parts).repartition("u", "v", "salt"))
        size = F.log("n") / F.log(F.lit(100.0 / self.percent))
        merged = merged.withColumns({"band0": F.floor(size / 2).cast("int"), "band1": F.floor((size + 1) / 2).cast("int")})
        for band in ("band0", "band1"):
            alike = Window.partitionBy("u", "v", "salt", band).orderBy("rare", "cls")
            alike = alike.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
            some = F.array(*[F.nth_value(F.struct("rare", "cls", "n"), i + 1).over(alike) for i in range(HEADS)])
            merged = merged.withColumn(f"of_{band}", F.filter(some, lambda h: h < F.struct("rare", "cls", "n")))
        heads = F.array_union("of_band0", "of_band1").alias("heads")
        saved = self.ws.save(merged.select("u", "v", "cls", "n", "pos", "w", "rare", "salt", "hot", "band0", heads), "columns")
        self.ws.drop(*[f"part{i}" for i in range(PARTS)])
        return saved

    def near(self, x: str, y: str) -> Column:
        """Sizes that allow the similarity."""
        return F.least(x, y) * 100 >= F.greatest(x, y) * self.percent

    def need(self, n: str, m: str) -> Column:
        """The least overlap that reaches the similarity."""
        return F.ceil((F.col(n) + F.col(m)) * self.percent / (100.0 + self.percent) - 1e-9)

    def enough(self, n: str, m: str, shared: Column) -> Column:
        """Whether ``shared`` prefix columns leave the overlap that the sizes need within reach.

        All common columns up to the smaller of the two last prefix columns are prefix columns
        of both; beyond it one row has ``n - prefix`` columns left, ``ceil(t n) - 1``.
        """
        left = F.ceil(F.greatest(n, m) * self.percent / 100.0 - 1e-9) - 1
        return shared + left >= self.need(n, m)

    def first_round(self, columns: DataFrame) -> DataFrame:
        """Pairs of each row with the heads of its columns; linear in the columns.

        Pairs that these columns alone don't support are left to the second round.
        """
        pairs = columns.select("cls", "n", "w", F.explode("heads").alias("head")).select("cls", "n", F.col("head.cls").alias("other"), F.col("head.n").alias("m"), "w")
        # the salts of a hot column meet through the first of each
        hot = columns.filter("hot")
        firsts = hot.groupBy("u", "v", "band0", "salt").agg(F.min(F.struct("rare", "cls", "n")).alias("one"))
        chain = Window.partitionBy("u", "v", "band0").orderBy("one")  # HOT_SALTS rows at most
        chained = firsts.withColumn("head", F.lag("one").over(chain)).filter("head IS NOT NULL")
        pairs = pairs.union(chained.select("one.cls", "one.n", F.col("head.cls").alias("other"), F.col("head.n").alias("m"), F.lit(1).cast("long").alias("w")))
        return (
            pairs.filter(self.near("n", "m"))
            .groupBy(F.least("cls", "other").alias("a"), F.greatest("cls", "other").alias("b"))
            .agg(F.sum("w").alias("shared"), F.first("n").alias("n"), F.first("m").alias("m"))
            .filter(self.enough("n", "m", F.col("shared")))
            .select("a", "b")
        )

    def alike(self, pairs: DataFrame, members: DataFrame) -> DataFrame:
        """The pairs whose signatures leave the similarity within reach."""
        x, y = (members.select(F.col("cls").alias(c), F.col("n").alias(f"n{c}"), *[F.col(s).alias(f"{s}{c}") for s in SIGNS]) for c in "ab")
        differ = reduce(lambda p, q: p + q, [F.bit_count(F.col(f"{s}a").bitwiseXOR(F.col(f"{s}b"))) for s in SIGNS])
        return pairs.join(x, "a").join(y, "b").filter(differ <= F.col("na") + F.col("nb") - 2 * self.need("na", "nb")).select("a", "b")

    def second_round(self, columns: DataFrame, linked: DataFrame, signs: DataFrame, done: DataFrame) -> DataFrame:
        """Pairs across the components of ``linked`` that the bounds leave."""
        labels = connected_components(linked, "a", "b").select(F.col("node").alias("cls"), F.col("component").alias("comp"))
        of_col = Window.partitionBy("u", "v")
        cells = (
            columns.select("u", "v", "cls", "n", "pos", "w")
            .join(labels, "cls", "left")
            .withColumn("comp", F.coalesce("comp", "cls"))
            .withColumns({"x": F.min("comp").over(of_col), "y": F.max("comp").over(of_col)})
            .filter("x <> y")
            .drop("x", "y")
        )
        cells = self.ws.save(self.placed(self.ws.save(cells, "open")).join(signs, "cls"), "cells")
        return self.meetings(cells).distinct().join(done, ["a", "b"], "left_anti")

    def placed(self, cells: DataFrame) -> DataFrame:
        """Open columns with those before them among the first ``FIRSTS`` of their class, and the weight from them on."""
        own = Window.partitionBy("cls").orderBy("pos")
        whole = own.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        firsts = F.array(*[F.nth_value(F.xxhash64("u", "v"), i + 1).over(whole) for i in range(FIRSTS)])
        before = F.least(F.row_number().over(own) - 1, F.lit(FIRSTS))
        return cells.withColumns(
            {
                "live": F.sum("w").over(own.rowsBetween(Window.currentRow, Window.unboundedFollowing)),
                "before": F.slice(firsts, F.lit(1), before),
            }
        )

    def meetings(self, cells: DataFrame) -> DataFrame:
        """Pairs across components, within the bounds, at their first common column.

        All rows have the columns in one order and a pair's common columns are all open, so its overlap lies at
        the first of them and after: the bounds hold there for every pair that links. A pair that
        first meets beyond the ``FIRSTS`` of a row may come more than once.
        """
        # both sides have the same columns, so Spark shuffles them once
        l, r = (lambda c: F.col(f"l.{c}")), (lambda c: F.col(f"r.{c}"))
        rest = F.least(l("n") - l("pos"), r("n") - r("pos"))
        need = self.need("l.n", "r.n")
        differ = reduce(lambda x, y: x + y, [F.bit_count(l(s).bitwiseXOR(r(s))) for s in SIGNS])
        return (
            cells.alias("l").join(cells.alias("r"), (l("u") == r("u")) & (l("v") == r("v")))
            .filter((l("cls") < r("cls")) & (l("comp") != r("comp")))
            .filter(self.near("l.n", "r.n") & (rest >= need))
            .filter(self.enough("l.n", "r.n", F.least("l.live", "r.live")) & (differ <= l("n") + r("n") - 2 * need))
            .filter(~F.arrays_overlap("l.before", "r.before"))
            .select(l("cls").alias("a"), r("cls").alias("b"))
        )

    def links(self, pairs: DataFrame, members: DataFrame, name: str) -> DataFrame:
        """The pairs whose exact similarity reaches the bound; one text of each class is fetched."""
        ids = pairs.select(F.col("a").alias("cls")).union(pairs.select(F.col("b").alias("cls"))).distinct().join(members.select("cls", "key"), "cls")
        ids = self.ws.save(ids.select("cls", "key"), f"ids-{name}")
        wanted = ids.count()
        found = self.docs.select("key", "text").join(F.broadcast(ids) if wanted <= BROADCAST_IDS else ids, "key")
        texts = self.ws.save(found.select("cls", "text").mapInArrow(_of_class(self.size), "cls binary, text string"), f"texts-{name}")
        if texts.count() > wanted:  # rows that repeat id and text
            texts = texts.dropDuplicates(["cls"])
        with_both = pairs.join(texts.alias("x"), F.col("a") == F.col("x.cls")).join(texts.alias("y"), F.col("b") == F.col("y.cls"))
        with_both = with_both.select("a", "b", F.col("x.text").alias("text_a"), F.col("y.text").alias("text_b"))
        counted = with_both.mapInArrow(
            _overlaps(self.size), "a binary, b binary, overlap long, na long, nb long"
        )
        linked = counted.filter(F.col("overlap") * 100 >= (F.col("na") + F.col("nb") - F.col("overlap")) * self.percent)
        linked = self.ws.save(linked.select("a", "b"), f"links-{name}")
        self.ws.drop(f"texts-{name}", f"ids-{name}")
        return linked

    def components(self) -> DataFrame:
        """(doc_id, key, n_shingles, component_id) of every row."""
        rows = self.profile()
        members = rows.filter("n > 0").groupBy("cls").agg(F.min("doc_id").alias("doc_id"), F.min("key").alias("key"), F.max("n").alias("n"), *[F.max(s).alias(s) for s in SIGNS])
        members = self.ws.save(members, "members")
        columns = self.columns()
        pairs = self.ws.save(self.alike(self.first_round(columns), members), "pairs")
        one = self.links(pairs, members, "one")
        more = self.ws.save(self.second_round(columns, one, members.select("cls", *SIGNS), pairs), "more")
        self.ws.drop("columns", "open", "cells", "pairs")
        two = self.links(more, members, "two")
        joined = connected_components(one.union(two), "a", "b").select(F.col("node").alias("cls"), F.col("component").alias("label"))
        joined = self.ws.save(joined.join(members.select("cls", "doc_id"), "cls"), "joined")
        # the classes of a large component are dealt over salts to meet its smallest id
        salts = F.array(*map(F.lit, range(HOT_SALTS)))
        least = joined.groupBy("label").agg(F.min("doc_id").alias("component_id")).withColumn("salt", F.explode(salts))
        salted = joined.withColumn("salt", F.pmod(F.xxhash64("cls"), F.lit(HOT_SALTS)).cast("int")).join(least, ["label", "salt"])
        alone = members.join(joined, "cls", "left_anti").select("cls", F.col("doc_id").alias("component_id"))
        by_class = self.ws.save(salted.select("cls", "component_id").union(alone), "by_class")
        self.ws.drop("members", "more", "joined", "links-one", "links-two")
        return rows.select("doc_id", "key", "n", "cls").join(by_class, "cls", "left").select(
            "doc_id",
            "key",
            F.col("n").alias("n_shingles"),
            F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        )


def row_key(doc_id: Column, text: Column) -> Column:
    """Tells rows of one id apart by their texts."""
    return F.xxhash64(doc_id, text)


def jaccard_components(docs: DataFrame, percent: int = 75, size: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id.

    Texts are lower-cased in A-Z and cut into words at ASCII white space; a row's set is its
    distinct ``size``-word shingles, the whole sequence where there are fewer words, empty
    without words or text (null: without). Rows link when 100 * overlap >= percent * union; an
    empty set links with nothing. component_id is the smallest doc_id reachable by links, the
    row's own included. Repeated rows share a component; rows that repeat an id with another
    text link by their own text. A null id links like any other and is never the smallest; where
    all ids of a component are null, so is component_id. An empty table gives no rows; other
    columns are ignored. N-grams are compared by 64-bit fingerprints, sets by 96-bit ones.
    """
    return JaccardJoin(docs, percent, size, id_col, text_col).components().drop("key")


def drop_near_copies(docs: DataFrame, percent: int = 75, size: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component, that with the smallest id, with all its columns.

    Rows without any shingle stay, and so do all rows of a component that have the id that stays
    (where all its ids are null: all of them). Columns of any name may be there.
    """
    ws = Workspace(docs.sparkSession, "drop-near-copies")
    found = JaccardJoin(docs, percent, size, id_col, text_col).components()
    gone = found.filter("NOT (component_id <=> doc_id)").select(F.col("doc_id").alias("id"), "key").distinct()
    gone = ws.save(gone.select(F.struct(F.col("id").alias("id"), F.col("key").alias("key")).alias(free_name(docs, "gone"))), "gone")
    few = gone.count() <= BROADCAST_IDS
    own = F.struct(F.col(id_col).cast("long").alias("id"), row_key(F.col(id_col).cast("long"), F.col(text_col)).alias("key"))
    return docs.join(F.broadcast(gone) if few else gone, own.eqNullSafe(F.col(gone.columns[0])), "left_anti")

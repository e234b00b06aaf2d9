"""Near-duplicate documents: fast similarity sketches, banding, exact verification.

A sketch has ``ROWS * BANDS`` coordinates. Each round hashes all shingles to a
bin and a value; a coordinate keeps the value of the first round that reaches
it. After as many rounds as there are coordinates, round t + i places every
shingle in bin i, so that every coordinate fills; for a set much larger than
the sketch a few rounds do, and the estimate concentrates as with independent
minima at the cost of one or two hash passes over the set.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtline.llm import common
from courtline.llm.components import components

#: 20 bands of 4: a pair of likeness 0.85 shares none with probability 4e-7, of 0.8 with 3e-5.
ROWS, BANDS = 4, 20
SIZE = ROWS * BANDS
_M1, _M2, _M3 = (np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words, kept while there are few enough."""

    LIMIT = 200_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_WORDS = WordHashes()


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` of the whole text, A-Z lower-cased."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    return np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``width`` words; of fewer words, of the whole sequence."""
    h = word_hashes(text)
    if not len(h):
        return h
    n = min(width, len(h))
    out = np.full(len(h) - n + 1, np.uint64(n))
    for i in range(n):
        out = mix(out * _M3 + h[i : len(h) - n + 1 + i])
    return np.unique(out)


def sketch(items: np.ndarray, size: int = SIZE) -> np.ndarray:
    """The sketch of a non-empty set of 64-bit hashes: one value for each coordinate."""
    out = np.full(size, np.iinfo(np.uint64).max)
    low = np.uint64((1 << 52) - 1)
    at, n = 0, len(items)
    while True:
        rounds = np.arange(at, at + max(1, 2 * size // n), dtype=np.uint64)[:, None]
        h = mix(items[None, :] + (rounds + np.uint64(1)) * _M3)
        bins = (h >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)
        bins = np.where(rounds < size, bins, (rounds - np.uint64(size)) % np.uint64(size)).astype(np.int64)
        # the round in the upper bits: an earlier round's value is always the smaller
        np.minimum.at(out, bins.ravel(), ((rounds << np.uint64(52)) | (mix(h) & low)).ravel())
        at += len(rounds)
        if out.max() < np.iinfo(np.uint64).max:
            return out


def bands(values: np.ndarray) -> np.ndarray:
    """One hash for each band of a sketch."""
    h = np.arange(BANDS, dtype=np.uint64)
    for i in range(ROWS):
        h = mix(h * _M3 + values[i::ROWS])
    return h.astype(np.int64)


_SKETCHED = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("same", pa.binary()), ("bands", pa.list_(pa.int64()))])


def _sketched(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.pieces(batches):
            sets = [shingles(t, width) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.array([bands(sketch(s)) if len(s) else None for s in sets], pa.list_(pa.int64())),
                ],
                schema=_SKETCHED,
            )
        _WORDS.clear()  # workers outlive tasks

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.pieces(batches):
            sets = [shingles(t, width) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                ],
                names=["same", "items"],
            )
        _WORDS.clear()

    return run


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` (a, b) whose full sets have ``100 * intersection >= percent * union``."""
    joined = pairs.join(sets.select(F.col("id").alias("a"), F.col("items").alias("x")), "a").join(
        sets.select(F.col("id").alias("b"), F.col("items").alias("y")), "b"
    )
    both = F.size(F.array_intersect("x", "y"))
    return joined.filter(100 * both >= percent * (F.size("x") + F.size("y") - both)).select("a", "b")


#: Places of a class's number below its doc_id, and the numbers used of them (so that a quotient isn't rounded up).
_UNIT, _USED = Decimal(10**18), 9 * 10**17


def _class_of(doc_id: Column, same: Column) -> Column:
    """A class's number, ordered by its smallest doc_id: classes of one doc_id differ by a hash of their sets."""
    low = F.pmod(F.xxhash64(same), F.lit(_USED)).cast("decimal(18,0)")
    return (doc_id.cast("decimal(19,0)") * F.lit(_UNIT) + low).cast("decimal(38,0)")


def _id_of(number: Column) -> Column:
    return F.floor(number / F.lit(_UNIT)).cast("long")


def classes(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row.

    Documents with equal shingle sets are one class, represented by the
    smallest doc_id and the set (rows that repeat a doc_id with other texts are
    other classes); classes that share a band are tested on their full sets,
    and links close transitively. Null, empty and wordless texts have no
    shingles and are linked with nothing: each is a component of its own.
    Repeated rows are in one component (and both ``kept`` if they share the
    smallest doc_id); a null doc_id is never a representative and gets a null component unless
    another member names it; an empty table gives no rows; columns other than
    doc_id and text are not read.

    A shingle that only one candidate has is in no intersection: classes with
    too many of them are linked with nothing and left out, exactly. Then a
    bucket's members are tested against one pivot each, the member that shares
    most (linear in the bucket). Where a bucket still holds more than one
    component, members that the pivot isn't linked with look for others by
    what sets them apart from it (``_beyond``); no pair of a settled group is
    made and no link is lost.
    """
    return _grouped(docs, width, percent).select("doc_id", "n_shingles", "component_id", "kept")


def _grouped(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``classes`` with ``same``, the digest of the row's set, and ``first``, whether its class is the one of its component to keep."""
    common.short_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = common.stored(
        texts.mapInArrow(_sketched(width), "doc_id long, n_shingles long, same binary, bands array<long>"), "sketches"
    )
    full = rows.filter("n_shingles > 0")
    same = full.groupBy("same").agg(F.min("doc_id").alias("doc_id")).withColumn("class", _class_of(F.col("doc_id"), F.col("same")))
    with common.settings(docs.sparkSession, RUNTIME_FILTER):
        found = common.stored(_links(texts, full, same, width, percent), "links")
    merged = components(found)
    named = (
        same.join(merged.withColumnRenamed("node", "class"), "class", "left")
        .select("same", F.coalesce("component", "class").alias("_component"))
    )
    component = F.when(F.col("n_shingles") > 0, _id_of(F.col("_component"))).otherwise(F.col("doc_id"))
    return rows.join(named, "same", "left").select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"),
        "same",
        F.coalesce((F.col("n_shingles") == 0) | (_class_of(F.col("doc_id"), F.col("same")) == F.col("_component")), F.lit(False)).alias("first"),
    )


#: Runtime filters from 16 MB of input on, from lists of up to 1 GB.
RUNTIME_FILTER = {
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "16MB",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1GB",
}


def _links(texts: DataFrame, full: DataFrame, same: DataFrame, width: int, percent: int) -> DataFrame:
    """Edges (a, b) between classes that make all links' components."""
    heads = full.select("same", "bands", "doc_id").join(same, ["same", "doc_id"]).dropDuplicates(["same"])
    member = heads.select(F.col("class").alias("id"), "doc_id", "same", F.explode(F.transform("bands", lambda h, i: F.xxhash64(h, i))).alias("bucket"))
    shared = member.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    member = common.stored(member.join(shared, "bucket").drop("n"), "buckets")
    # a stored list of keys tells the planner its true size: it broadcasts a short one and else filters the texts
    # with a Bloom filter of it before they are shuffled
    near = common.stored(member.groupBy("id", "doc_id", "same").agg(F.count(F.lit(1)).alias("shared")), "near").filter("shared > 0")
    member = member.select("id", "bucket")
    # of the texts of a repeated doc_id, those of the classes: rows meet by their sets
    sets = common.stored(
        texts.join(near.select("doc_id"), "doc_id", "left_semi")
        .mapInArrow(_sets(width), "same binary, items array<long>")
        .dropDuplicates(["same"])
        .join(near.select("id", "same"), "same")
        .select("id", "items"),
        "sets",
    )
    # the items of each set that another candidate has: at most those are in an intersection
    item = sets.select("id", F.explode("items").alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("id"))
    alone = item.filter("n = 1").groupBy("id").agg(F.count(F.lit(1)).alias("alone"))
    bound = (
        sets.select("id", F.size("items").alias("size"))
        .join(alone, "id", "left")
        .select("id", "size", (F.col("size") - F.coalesce("alone", F.lit(0))).alias("most"))
        .filter(100 * F.col("most") >= percent * F.col("size"))
    )
    member = member.join(bound, "id").withColumn("u", (F.xxhash64(F.lit("pivot"), "id") / float(1 << 64)) + 0.5)
    count = member.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(-F.col("most") / F.col("size"), "u", "id", "size", "most")).alias("p")
    )
    member = common.stored(member.join(count.filter("n > 1"), "bucket"), "members")

    room = (100 + percent) * F.least("most", "p.most") >= percent * (F.col("size") + F.col("p.size"))
    star = member.filter((F.col("id") != F.col("p.id")) & room)
    star = star.select(F.greatest("id", "p.id").alias("a"), F.least("id", "p.id").alias("b")).distinct()
    edges = common.stored(_linked(star, sets, percent), "edges")
    label = components(edges).withColumnRenamed("node", "id")
    found = member.filter("n > 2").select("bucket", "id", F.col("p.id").alias("pivot")).join(label, "id", "left")
    found = found.withColumn("c", F.coalesce("component", "id"))
    mixed = found.groupBy("bucket").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo != hi").select("bucket")
    group = common.stored(found.join(mixed, "bucket").select("pivot", "id", "c").distinct(), "mixed")
    return edges.union(_beyond(group, sets, percent))


#: Members of one (pivot, item) group that are compared with one of them before all pairs are, how often at most, and
#: the part of these pairs that must be links for components to be joined by them.
CROWD, ROUNDS, WORTH = 32, 4, 0.05


def _beyond(group: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between the different components ``c`` under one pivot: with those inside of components, all there are.

    The symmetric difference of x and y is that of their differences dx and dy
    to the pivot. A link allows at most h = (|x| + |y|) (100 - p) / (100 + p)
    differing shingles, so dx and dy have at least o = (|dx| + |dy| - h) / 2 in
    common. Of two members in different components one, x, isn't linked with
    the pivot; then o > 0 (sizes differ by no more than differences do). So
    with the shingles of both in one order, rarest first, one of the first
    |dx| - o + 1 of dx is one of the first |dy| - o + 1 of dy: members join on
    those. Copies of one template differ from it in shingles that hardly two
    of them share, so they meet few others.

    Members far from the pivot may still be a cluster of their own, all of
    which share what sets them apart. So groups of more than ``CROWD`` members
    of several components are first compared with one of their members each,
    which is linear in the group, and components are joined by the links found,
    again as long as there are clusters to find. All pairs are then made of members whose
    components still differ; no link is lost, whatever the rounds found.
    """
    p = percent
    own = group.join(sets.select("id", F.col("items").alias("x")), "id")
    both = own.join(sets.select(F.col("id").alias("pivot"), F.col("items").alias("t")), "pivot")
    apart = both.select(
        "pivot", "id", "c", F.size("x").alias("size"), F.size("t").alias("t_size"), F.concat(F.array_except("x", "t"), F.array_except("t", "x")).alias("d")
    ).withColumn("apart", F.size("d"))
    apart = apart.withColumn("far", F.col("apart") * (100 + p) > (F.col("size") + F.col("t_size")) * (100 - p))
    one = common.stored(apart.select("pivot", "id", "c", "size", "apart", "far", F.explode("d").alias("item")), "apart")
    often = one.groupBy("pivot", "item").agg(F.count(F.lit(1)).alias("often")).filter("often > 1")
    # an item that one member alone differs in meets nobody, but takes its place in the order
    ranked = one.join(often, ["pivot", "item"], "left").withColumn(
        "k", F.row_number().over(Window.partitionBy("pivot", "id").orderBy(F.coalesce("often", F.lit(1)), "item")) - 1
    )
    # a member meets x, which is far, within its first places; x itself, within all
    ranked = ranked.filter((F.col("often").isNotNull()) & (F.col("far") | (F.col("k") * (100 + p) < F.col("apart") * 100)))
    ranked = common.stored(ranked.drop("often"), "ranked")
    found = []
    while len(found) < ROUNDS:
        who = F.struct(F.xxhash64(F.lit(len(found)), "id").alias("u"), "id", "c", "size", "apart", "far", "k")
        crowd = ranked.groupBy("pivot", "item").agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("lo"), F.max("c").alias("hi"), F.max(who).alias("y"))
        crowd = crowd.filter(f"n > {CROWD} AND lo != hi").select("pivot", "item", *[F.col(f"y.{c}").alias(f"y_{c}") for c in _MEMBER])
        star = common.stored(_met(ranked.join(crowd, ["pivot", "item"]), p), "star")
        if not (pairs := star.count()):
            break
        links = common.stored(_linked(star.select("a", "b"), sets, p).join(star, ["a", "b"]), "links")
        if links.count() < WORTH * pairs:
            break
        found.append(links.select("a", "b"))
        merged = components(links.select(F.col("c_a").alias("a"), F.col("c_b").alias("b"))).withColumnRenamed("node", "c")
        ranked = common.stored(ranked.join(merged, "c", "left").withColumn("c", F.coalesce("component", "c")).drop("component"), "ranked")
    y = ranked.filter(F.col("k") * (100 + p) < F.col("apart") * 100).select("pivot", "item", *[F.col(c).alias(f"y_{c}") for c in _MEMBER])
    rest = _linked(_met(ranked.filter("far").join(y, ["pivot", "item"]), p).select("a", "b"), sets, p)
    for links in found:
        rest = rest.union(links)
    return rest


_MEMBER = ("id", "c", "size", "apart", "far", "k")


def _met(pairs: DataFrame, percent: int) -> DataFrame:
    """(a, b, c_a, c_b), once each: those of the pairs (x and y_ columns, met at places k and y_k) that may be linked."""
    p = percent
    # twice (100 + p) o, and what is left of each from the place on
    least = (F.col("apart") + F.col("y_apart")) * (100 + p) - (F.col("size") + F.col("y_size")) * (100 - p)
    room = [2 * (F.col(f"{s}apart") - F.col(f"{s}k")) * (100 + p) >= least for s in ("", "y_")]
    met = pairs.filter((F.col("c") != F.col("y_c")) & (F.col("far") | F.col("y_far")) & room[0] & room[1])
    first = F.col("id") > F.col("y_id")
    return met.select(
        F.greatest("id", "y_id").alias("a"),
        F.least("id", "y_id").alias("b"),
        F.when(first, F.col("c")).otherwise(F.col("y_c")).alias("c_a"),
        F.when(first, F.col("y_c")).otherwise(F.col("c")).alias("c_b"),
    ).distinct()


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest doc_id; all columns unchanged.

    Rows with a null doc_id and rows without words stay. Of repeated rows with
    one doc_id and one set of shingles, one stays; rows that repeat a doc_id with another
    set are judged by that set, so that clean texts stay whatever their key.
    """
    groups = common.stored(_grouped(docs, width, percent), "groups")
    again = groups.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_again")).count().filter("count > 1").select("_again")
    again = common.stored(again, "again")
    gone = groups.filter("NOT first AND doc_id IS NOT NULL").select(F.col("doc_id").alias("_gone"), F.col("same").alias("_same")).distinct()
    gone = common.stored(gone, "gone")  # of a size the planner knows
    if again.isEmpty():
        return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
    once = docs.join(again, docs["doc_id"] == again["_again"], "left_anti")
    once = once.join(gone, once["doc_id"] == gone["_gone"], "left_anti")

    @F.arrow_udf("binary")
    def digest(texts: pa.Array) -> pa.Array:
        """That of the set of shingles; null for a text without words."""
        out = []
        for t in texts:  # one text at a time
            s = shingles(t.as_py(), width)
            out.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
        _WORDS.clear()
        return pa.array(out, pa.binary())

    rest = docs.join(again, docs["doc_id"] == again["_again"], "left_semi").withColumn("_set", digest("text"))
    wordless = rest.filter("_set IS NULL").drop("_set")
    rest = rest.filter("_set IS NOT NULL")
    rest = rest.join(gone, (rest["doc_id"] == gone["_gone"]) & (rest["_set"] == gone["_same"]), "left_anti").dropDuplicates(["doc_id", "_set"]).drop("_set")
    return once.unionByName(rest).unionByName(wordless)

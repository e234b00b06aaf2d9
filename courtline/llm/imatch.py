"""I-Match fingerprints over randomised lexicon subsets.

Terms within a band of inverse document frequency are the lexicon: those in at
most a part ``MOST`` of all documents, and in one document in any table. The
band's other end is open, so rare terms tell texts apart whatever the table's
size. Subset (f, l) keeps
each term with rate 2^-l by the f-th of ``FAMILIES`` independent draws, so that
the subsets of a family are nested. The sorted distinct terms that a document
has in a subset are hashed, for the levels at which it is expected to have
one, a half and a quarter of a term. A change of a document leaves the subsets
that miss the changed terms as they were, so the share of equal hashes
approaches the share of common terms; equal texts have equal fingerprints.

Frequencies are exact, and no document's terms are sent anywhere for them: the
terms beyond the band are few (a document's mean terms divided by ``MOST``), so
tasks are given those and count only what may be one of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtline.llm import common
from courtline.llm.minhash import mix

#: The greatest part of all documents that a term of the lexicon is in.
MOST = 0.05
FAMILIES, LEVELS = 24, 3
NONE = "-"
_SALTS = np.array([(f + 1) * 0x9E3779B97F4A7C15 % (1 << 64) for f in range(FAMILIES)], np.uint64)
#: Draws made at once.
_DRAWS = 2_000_000


#: The base of a word's hash: the sum of its bytes plus one times the base's powers, modulo 2^64, and ``mix`` of that.
BASE = 0x9E3779B97F4A7C15
_powers = np.ones(1, np.uint64)


def _up_to(n: int) -> np.ndarray:
    """The first ``n`` powers of BASE."""
    global _powers
    if len(_powers) < n:
        _powers = np.concatenate([[np.uint64(1)], np.cumprod(np.full(2 * n, BASE, np.uint64))])
    return _powers


def terms_of(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's terms (words ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased), all words at once."""
    b = np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), np.uint8) if text else np.zeros(0, np.uint8)
    inside = (b != 32) & ((b < 9) | (b > 13))
    starts = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]])) if len(b) else np.zeros(0, np.int64)
    if not len(starts):
        return np.zeros(0, np.uint64)
    spans = np.diff(starts, append=len(b))
    place = np.arange(starts[0], len(b)) - np.repeat(starts, spans)
    value = (b[starts[0] :].astype(np.uint64) + np.uint64(1)) * _up_to(int(spans.max()))[place]
    value[~inside[starts[0] :]] = 0
    return np.unique(mix(np.add.reduceat(value, starts - starts[0])))


#: Terms of a task's documents that are gathered before they are counted.
_GATHERED = 4_000_000


def _counted(low: float | None, wanted: np.ndarray | None):
    """A task's counts of the terms in ``wanted``, or of those in the part ``low`` of its documents; its documents at the null term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, size = 0, 0
        parts: list[np.ndarray] = []
        terms, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def add_up() -> None:
            nonlocal terms, n, parts, size
            seen, times = np.unique(np.concatenate(parts), return_counts=True) if parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            both, at = np.unique(np.concatenate([terms, seen]), return_inverse=True)
            total = np.zeros(len(both), np.int64)
            np.add.at(total, at, np.concatenate([n, times]))
            terms, n, parts, size = both, total, [], 0

        for b in common.pieces(batches):
            for text in b.column("text"):
                own = terms_of(text.as_py())
                if wanted is not None:
                    own = own[_among(own, wanted)]
                parts.append(own)
                size += len(own)
                docs += 1
            if size > _GATHERED:
                add_up()
        add_up()
        keep = n >= (low * docs if low is not None else 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array([None, *terms[keep].view(np.int64).tolist()], pa.int64()), pa.array([docs, *n[keep].tolist()], pa.int64())], names=["term", "n"]
        )

    return run


def _among(terms: np.ndarray, sorted_: np.ndarray) -> np.ndarray:
    """Whether each term is in a sorted array."""
    if not len(sorted_):
        return np.zeros(len(terms), bool)
    return sorted_[np.minimum(np.searchsorted(sorted_, terms), len(sorted_) - 1)] == terms


def too_frequent(docs: DataFrame, most: float = MOST) -> np.ndarray:
    """The terms in more than the part ``most`` of all documents and in two at least, sorted; exact, over all documents.

    A task sends the terms in a hundredth of that part of its own documents:
    what it holds back adds up to no more than that hundredth of all. So only
    terms whose sum comes that near to the bound are counted again, in all
    documents. At most 1 / ``most`` (and in the second count 100 / ``most``)
    times a document's mean terms can reach the driver.
    """
    low = most / 100
    common.short_batches(docs.sparkSession)

    def counts(low: float | None, wanted: np.ndarray | None) -> DataFrame:
        return docs.select("text").mapInArrow(_counted(low, wanted), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))

    sums = common.stored(counts(low, None), "terms")
    total = sums.filter("term IS NULL").first()
    total = total["n"] if total is not None else 0
    bound = max(1.0, most * total)
    near = sums.filter("term IS NOT NULL").filter(F.col("n") > bound - low * total).collect()
    unsure = np.array(sorted(r["term"] for r in near if r["n"] <= bound), np.int64).view(np.uint64)
    sure = [r["term"] for r in near if r["n"] > bound]
    if len(unsure):
        unsure.sort()
        sure += [r["term"] for r in counts(None, unsure).filter("term IS NOT NULL").filter(F.col("n") > bound).collect()]
    out = np.array(sure, np.int64).view(np.uint64)
    out.sort()
    return out


def fingerprint(text: str | None, frequent: np.ndarray) -> str:
    """``level:`` and eight hex digits for each subset of each family, ``-`` for one without a term; ``-`` for no terms.

    Of the text's terms, those that are not in ``frequent`` (sorted).
    """
    terms = terms_of(text)
    terms = terms[~_among(terms, frequent)]
    if not len(terms):
        return NONE
    low = round(float(np.log2(len(terms))))
    limits = [(1 << 64) >> (low + k) for k in range(LEVELS)]
    found: list[list[tuple[int, int]]] = [[] for _ in range(FAMILIES)]
    step = max(1, _DRAWS // len(terms))
    for at in range(0, FAMILIES, step):
        draws = mix(terms[None, :] + _SALTS[at : at + step, None])
        rows, columns = np.nonzero(draws <= np.uint64(limits[0] - 1))
        for f, t, d in zip(rows.tolist(), terms[columns].tolist(), draws[rows, columns].tolist(), strict=True):
            found[at + f].append((t, d))
    out = []
    for kept in found:  # in the order of the terms; most subsets have one or none, and many a level that of the one before
        size, digest = 0, NONE
        for level, limit in enumerate(limits):
            if level and kept:
                kept = [x for x in kept if x[1] < limit]
            if len(kept) != size:
                size = len(kept)
                digest = f"{xxhash.xxh32_intdigest(b''.join([t.to_bytes(8, 'little') for t, _ in kept])):08x}" if kept else NONE
            out.append(digest)
    return f"{low}:" + ",".join(out)


def likeness(a: str, b: str) -> float:
    """Share of equal hashes among the subsets that both texts look at and either has terms in.

    1 for equal fingerprints, so for two texts without any term; 0 for texts
    whose numbers of terms are so unlike that no level is common.
    """
    if a == b:
        return 1.0
    if NONE in (a, b):
        return 0.0
    (low_a, hashes_a), (low_b, hashes_b) = ((int(level), h.split(",")) for level, h in (x.split(":") for x in (a, b)))
    equal = seen = 0
    for level in range(max(low_a, low_b), min(low_a, low_b) + LEVELS):
        for x, y in zip(hashes_a[level - low_a :: LEVELS], hashes_b[level - low_b :: LEVELS], strict=True):
            if x != NONE or y != NONE:
                seen += 1
                equal += x == y
    return equal / seen if seen else 0.0


def edited(text: str, following: str) -> str:
    """``text`` with its last half (rounded down) replaced by as much of the start of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_OUT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)


def _compared(frequent, rows: Iterator[tuple[int, int | None, str, bool]]) -> Iterator[tuple]:
    """Rows in order (block, doc_id, text, whether it only shows what comes next) to results."""
    before = None
    for block, doc_id, text, shown in rows:
        print_ = fingerprint(text, frequent)
        if before is not None and before[0] == block:
            _, d, t, p = before
            new = edited(t, text)
            e = fingerprint(new, frequent)
            yield d, len(t), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), p, e, likeness(p, e), likeness(p, print_)
        before = None if shown else (block, doc_id, text, print_)


def _blocks(texts: DataFrame, rows_per_block: int):
    """Cuts of the descending ids, and for each block between them its first number and number of parts.

    Blocks are cut at quantiles of the ids. An id (or the lack of one) with
    several blocks' rows has a block of its own, in as many parts by the hash
    of the text. Both lists are as long as the number of blocks.
    """
    n = texts.select("doc_id").count()
    count = max(1, min(n // rows_per_block, 100_000))
    at = F.array(*[F.lit((i + 1) / count) for i in range(count - 1)])
    cuts = (texts.agg(F.percentile_approx("doc_id", at, F.lit(max(10_000, 20 * count)))).first()[0] or []) if count > 1 else []
    hot = {r["doc_id"]: -(-r["count"] // rows_per_block) for r in texts.groupBy("doc_id").count().filter(F.col("count") > 4 * rows_per_block).collect()}
    own = {d for d in hot if d is not None}
    ends = np.array(sorted({*cuts, *own, *(d - 1 for d in own)}), np.int64)
    # block 0 holds the greatest ids, the last but one those up to the first cut, the last the rows without id
    parts = np.ones(len(ends) + 2, np.int64)
    for d in own:
        parts[len(ends) - np.searchsorted(ends, d)] = hot[d]
    parts[-1] = hot.get(None, 1)
    return ends, np.concatenate([[0], np.cumsum(parts)[:-1]]), parts


def compare(docs: DataFrame, frequent: np.ndarray | None = None, rows_per_block: int = 4000) -> DataFrame:
    """Every document's fingerprint, and those of its edited text and of the next document.

    Documents are taken by descending doc_id, those of one id by a hash of the
    text, null ids last; after the last comes the first (for a single row,
    itself). Null texts are empty; texts are used whole. Repeated rows follow
    each other. An empty table gives no rows. Only doc_id and text are read.
    A text without a term in the lexicon has the fingerprint ``-``.

    The order is cut into blocks, one for each task, so that whole texts are
    shuffled once; each block also gets the first document of the next one.
    """
    spark = docs.sparkSession
    common.short_batches(spark)
    sent = spark.sparkContext.broadcast(too_frequent(docs) if frequent is None else frequent)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ends, first_of, parts = _blocks(texts, rows_per_block)

    @F.arrow_udf("int")
    def block_of(ids: pa.Array, hashes: pa.Array) -> pa.Array:
        """The number of the part that a row is in, in the order of the rows."""
        v = ids.fill_null(0).to_numpy(zero_copy_only=False)
        block = np.where(ids.is_null().to_numpy(zero_copy_only=False), len(parts) - 1, len(ends) - np.searchsorted(ends, v, side="left"))
        share = (hashes.to_numpy(zero_copy_only=False) >> np.int64(33)) + (1 << 30)  # 31 bits, in the order of the hashes
        return pa.array(first_of[block] + (share * parts[block] >> np.int64(31)), pa.int32())

    dealt = texts.withColumn("hash", F.xxhash64("text")).withColumn("block", block_of("doc_id", "hash"))
    # the first document of each block: its greatest id, then its least hash and text; one row for each block
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.bitwise_not("doc_id").alias("down"), "hash")
    least = common.stored(dealt.groupBy("block").agg(F.min(order).alias("_first")), "firsts")
    least = least.select("block", F.when(~F.col("_first.none"), F.bitwise_not("_first.down")).alias("_d"), F.col("_first.hash").alias("_h"))
    here = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("hash") == F.col("_h"))
    firsts = dealt.drop("block").join(F.broadcast(least), here).groupBy("block").agg(F.min("text").alias("text"), F.max("doc_id").alias("doc_id"), F.max("hash").alias("hash"))
    filled = sorted(r["block"] for r in least.select("block").collect())  # one number for each block
    shown_in = spark.createDataFrame(
        [(b, filled[i - 1] if i else filled[-1]) for i, b in enumerate(filled)] or [(-1, -1)], "block int, _to int"
    )
    shown = firsts.join(F.broadcast(shown_in), "block").select("doc_id", "text", "hash", F.col("_to").alias("block"), F.lit(True).alias("shown"))
    rows = dealt.select("doc_id", "text", "hash", "block", F.lit(False).alias("shown")).union(shown)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            for b in common.pieces(batches):
                yield from zip(*(b.column(c).to_pylist() for c in ("block", "doc_id", "text", "shown")), strict=True)

        part: list[tuple] = []
        for r in _compared(sent.value, each()):
            part.append(r)
            if len(part) == common.ARROW_ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part, strict=True), _OUT, strict=True)], schema=_OUT)
                part = []
        if part:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part, strict=True), _OUT, strict=True)], schema=_OUT)

    parted = rows.repartitionById(int(parts.sum()), F.col("block")).sortWithinPartitions("block", "shown", F.desc_nulls_last("doc_id"), "hash", "text")
    return parted.drop("hash").mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")

"""Periodic runs of words, found by an online sparse diagonal DP.

Words are read one by one. A word's earlier occurrences raise the match length
of the diagonals at their lags; a diagonal that isn't raised ends, and is a run
if it was long enough. Single words recur far too often for that, so an
occurrence counts with the words before it, at levels of k = 16, 32, 64, ...
words; level k serves periods in (k/2, k], the first one all up to 16. Two facts make
this exact, and linear per level:

* A run of period p has at least ``max(24, 3p) - p`` words that equal the word
  p before them, which is at least the k of its level: its diagonal is met.
* Take a word of the run whose k words and the word p earlier all lie in it. A
  nearer occurrence of these k >= p words at lag q < p would, by Fine and Wilf,
  give the run a smaller period. So the nearest earlier occurrence is at lag p
  exactly, and only that one is looked at.

So each level has one entry for each context and one live diagonal, whatever a
text repeats. Texts without a recurring context of 16 words (equal contexts
have equal hashes) have no run and are not looked at further.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtline.llm import common

#: The least words of a run, and the least number of its periods.
LEAST, PERIODS = 24, 3
#: Words of the first level's context: no run has fewer matches on its diagonal.
FIRST = 16

_OUT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_runs", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("period", pa.int64()),
        ("exponent_milli", pa.int64()),
        ("runs_sha256", pa.string()),
        ("collapsed_sha256", pa.string()),
    ]
)
_COLUMNS = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def words_of(text: str | None) -> list[bytes]:
    """The ``[^\\x20\\x09-\\x0D]+`` of a text: what ``bytes.split`` takes as words."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def looped(words: list, doc_id: int | None) -> list:
    """The words of one document in ten, by its id, looped from a place and with a period that the id fixes.

    A document without an id stays as it is.
    """
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    loop = words[a : a + p]
    return words[:a] + (loop * -(-(n - a) // p))[: n - a]


def _recurs(words: Sequence) -> bool:
    """Whether some context of FIRST words may recur: a rolling hash by doubling, never wrongly False."""
    n = len(words)
    if n < LEAST:
        return False
    h = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    k = 1
    while k < FIRST:
        h = (h[k:] ^ (h[k:] >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + h[:-k] * np.uint64(0xD1B54A32D192ED03)
        k *= 2
    h.sort()
    return bool((h[1:] == h[:-1]).any())


def _levels(words: Sequence) -> Iterator[tuple[int, list[int]]]:
    """(k, ranks): equal ranks at i and j are equal ``words[i:i + k]``; exact, by doubling."""
    number: dict = {}
    ranks = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    k = 1
    while len(ranks):
        if k >= FIRST:
            yield k, ranks.tolist()
        if 2 * PERIODS * k > 2 * len(words) or len(ranks) <= k:  # the next level's least period is k + 1
            return
        pairs = ranks[:-k] * (int(ranks.max()) + 1) + ranks[k:]
        ranks = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
        k *= 2


def runs(words: Sequence) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of ``words`` by start, then period.

    A run is a stretch with smallest period q and ``max(24, 3 q)`` words or
    more that no neighbouring word extends with that period.
    """
    if not _recurs(words):
        return []
    found = []

    def ended(k: int, lag: int, first: int, last: int) -> None:
        """The diagonal at ``lag`` was raised by the contexts that start at first to last."""
        length = last + k - (first - lag)
        if length >= max(LEAST, PERIODS * lag):
            found.append((first - lag, length, lag))

    for k, ranks in _levels(words):
        least = 0 if k == FIRST else k // 2
        seen: dict[int, int] = {}
        live, first = 0, 0
        for i, r in enumerate(ranks):
            lag = i - seen.get(r, i)
            seen[r] = i
            if lag != live:
                if live:
                    ended(k, live, first, i - 1)
                live, first = (lag, i) if least < lag <= k else (0, 0)
        if live:
            ended(k, live, first, len(ranks) - 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words: Sequence, found: Sequence[tuple[int, int, int]]) -> list:
    """The words that no run holds after its first period."""
    kept, at = [], 0
    for a, b in sorted((start + period, start + length) for start, length, period in found):
        kept += words[at:a]
        at = max(at, b)
    return kept + list(words[at:])


def _row(doc_id: int | None, text: str | None) -> tuple:
    words = looped(words_of(text), doc_id)
    found = runs(words)
    best = None
    for s, n, p in found:
        if best is None or n * best[2] > best[1] * p or (n * best[2] == best[1] * p and (s, p) < (best[0], best[2])):
            best = (s, n, p)
    told = "".join(f"{s},{n},{p}\n" for s, n, p in found)
    left = b" ".join(collapsed(words, found) if found else words)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return doc_id, len(found), *top, hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(left).hexdigest()


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in common.pieces(batches):
        rows = [_row(d, t) for d, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _OUT, strict=True)], schema=_OUT)


def periodic(docs: DataFrame) -> DataFrame:
    """One row for each document: its runs, the one of the greatest exponent, and what is left of it without repeats.

    Documents are looped as ``looped`` says, so that runs are there to find.
    Texts are read whole; a null or empty text has no words and no runs (four
    nulls, the digests of empty strings); a null doc_id is kept and not looped;
    repeated rows each give their row; an empty table gives none. Only doc_id
    and text are read, so other columns' names cannot clash. Nothing is
    shuffled: a task holds 256 texts at a time.
    """
    common.short_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_found, _COLUMNS)

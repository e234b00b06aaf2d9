"""Best-fit packing of token sequences, planned on the histogram of lengths.

Only counts by length reach the plan (at most ``capacity`` numbers, whatever
the corpus): best-fit decreasing places all pieces of one length at once, as
ranges of ranks. A document then takes its place by a join on its length and
its rank within the length.
"""

from __future__ import annotations

import bisect
import itertools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtline.llm import common

CAPACITY = 4096
END_ID = 1

# --- tokens ------------------------------------------------------------------

_CUT = "\x01"
#: Outside of these, lower-casing a character by itself and composing it are the same everywhere, and letters are letters.
_UNSAFE = re.compile("[\u0130\u0250-\U0010ffff]")
_PUNCTUATION = r"[!-/:-@\[-`{-~]"
#: Marks between a letter or digit and white space: the tokenizer parts them from what is before them.
_MARKS = re.compile(f"{_PUNCTUATION}(?<=[0-9A-Za-z\u00df-\u00f6\u00f8-\u00ff]{_PUNCTUATION}){_PUNCTUATION}*+(?![^ ])")


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies, by byte; the space stays."""
    plain = [*range(0x20, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [*range(0x20), 0x20, *range(0x7F, 0xA1), 0xAD]
    return {b: chr(256 + i) for i, b in enumerate(others)} | {b: chr(b) for b in plain}


class WordIds(dict):
    """Ids of words as little-endian 32-bit bytes, by word.

    The tokenizer drops white space and never joins characters across it, so a
    text's ids are its words' ids one after another. Words split at ASCII
    white space only; any other white space is left to the tokenizer. New words
    are encoded together: plain letters are cut where a token ends a word, others
    between marks that are a token of their own. Plain letters need none of the
    tokenizer's normalizing and splitting, so its merges alone are run on them,
    where that gives what the whole tokenizer gives for every such letter.
    """

    #: Words held at most when a batch begins, and those kept between tasks: the first ones met, which are the common ones.
    LIMIT, KEPT = 250_000, 100_000

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.cut = self.tokenizer.encode(_CUT, add_special_tokens=False).ids
        self.joint = len(self.cut) == 1
        vocabulary = self.tokenizer.get_vocab()
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if suffix and t.endswith(suffix)]] = True
        self.letters = byte_letters()
        self.merges = Tokenizer(self.tokenizer.model)
        self.merges.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        every = [chr(i) for i in range(0x250) if chr(i).isalpha() and not _UNSAFE.search(chr(i))]
        probe = [" ".join([c, f"th{c}", f"{c}{c}er", f"a{c}e"]) for c in every]
        if [self._merged(p) for p in probe] != [self._whole(p) for p in probe]:
            self._merged = self._whole

    def _merged(self, text: str) -> list[int]:
        """Ids of words of plain letters by the merges alone."""
        text = text.lower()
        if not text.isascii():
            text = text.encode().decode("latin-1").translate(self.letters)
        return self.merges.encode(text, add_special_tokens=False).ids

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def one(self, word: str) -> bytes:
        return np.array(self._whole(word), "<u4").tobytes()

    def learn(self, words: set[str]) -> None:
        """Add ``words``."""
        ascii_ = [w for w in words if w.isascii() and w.isalpha()]
        others = words.difference(ascii_)
        letters = [w for w in others if w.isalpha() and not _UNSAFE.search(w)]
        others.difference_update(letters)
        whole = [w for w in others if self.joint and _CUT not in w and "<|" not in w]
        self._encode(ascii_, " ", self._merged, True)
        self._encode(letters, " ", self._merged, True)
        self._encode(whole, f" {_CUT} ", self._whole, False)
        for w in others.difference(whole):
            self[w] = self.one(w)

    def _encode(self, words: list[str], between: str, code, ends: bool) -> None:
        """Add ``words``, joined by ``between``: cut after the tokens that end a word, or at the cutting mark."""
        for at in range(0, len(words), 500):
            part = words[at : at + 500]
            ids = np.array(code(between.join(part)), "<u4")
            raw = ids.tobytes()
            if ends:
                stops = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
                starts = [0, *stops[:-1]]
            else:
                cuts = (np.flatnonzero(ids == self.cut[0]) * 4).tolist()
                starts, stops = [0, *(c + 4 for c in cuts)], [*cuts, len(raw)]
            if len(stops) != len(part) or stops[-1] != len(raw):
                self.update((w, self.one(w)) for w in part)
            else:
                self.update((w, raw[a:b]) for w, a, b in zip(part, starts, stops, strict=True))


_VOCABULARIES: dict[str, WordIds] = {}


def words_of(text: str) -> list[str]:
    if not _UNSAFE.search(text):
        text = text.lower()  # as the tokenizer does
    for c in "\n\t\v\f\r":
        if c in text:
            text = text.replace(c, " ")
    return _MARKS.sub(r" \g<0>", text).split(" ")


def encode(texts: list[str | None], path: str, end_id: int = END_ID) -> list[bytes]:
    """Ids of each whole text, then ``end_id``, as little-endian unsigned 32-bit bytes."""
    if path not in _VOCABULARIES:
        _VOCABULARIES[path] = WordIds(path)
    known = _VOCABULARIES[path]
    if len(known) > known.LIMIT:
        forget(path)
    end = np.array([end_id], "<u4").tobytes()
    # a special token's string may hold white space or join words: such a text is encoded as a whole
    words = [[] if t is None or "<|" in t else words_of(t) for t in texts]
    new = set().union(*words).difference(known)
    if new:
        known.learn(new)
    return [
        (known.one(text) if text is not None and "<|" in text else b"".join(map(known.__getitem__, ws))) + end
        for text, ws in zip(texts, words, strict=True)
    ]


def forget(path: str) -> None:
    """Keep only the words met first."""
    known = _VOCABULARIES.get(path)
    if known is not None and len(known) > known.KEPT:
        first = list(itertools.islice(known.items(), known.KEPT))
        known.clear()
        known.update(first)


_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row for each piece of each document; only documents longer than ``capacity`` have more than one."""
    common.short_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.give_back()  # what other operators' tasks left in this worker
        for b in common.pieces(batches):
            rows: list[tuple] = []
            for doc_id, raw in zip(b.column("doc_id").to_pylist(), encode(b.column("text").to_pylist(), tokenizer), strict=True):
                for k, at in enumerate(range(0, len(raw), 4 * capacity)):
                    part = raw[at : at + 4 * capacity]
                    rows.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part), part if with_ids else None))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            )
        forget(tokenizer)  # workers outlive tasks, and other operators need their memory
        common.give_back()

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _PIECE)
    return out if with_ids else out.drop("ids")


# --- plan --------------------------------------------------------------------


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts by length.

    Rows (length, lo, hi, sequence, per, offset): the pieces of that length
    with rank r from lo to hi - 1 go to sequence ``sequence + (r - lo) // per``
    at ``offset + (r - lo) % per * length``. Open sequences are kept as ranges
    of numbers with equal room, so the work and the plan depend on the lengths
    that occur, not on the number of pieces.
    """
    rows = []
    room: dict[int, list[tuple[int, int]]] = {}  # room left -> ranges (first sequence, number)
    rooms: list[int] = []  # keys of ``room`` in order

    def add(left: int, first: int, n: int) -> None:
        if left and n:
            if left not in room:
                room[left] = []
                bisect.insort(rooms, left)
            ranges = room[left]
            if ranges and ranges[-1][0] + ranges[-1][1] == first:
                ranges[-1] = (ranges[-1][0], ranges[-1][1] + n)
            else:
                ranges.append((first, n))

    made = 0
    for length in sorted((x for x, n in counts.items() if n > 0), reverse=True):
        left, rank = counts[length], 0
        while left:
            i = bisect.bisect_left(rooms, length)
            if i < len(rooms):
                space = rooms[i]
                first, n = room[space].pop()
                if not room[space]:
                    del room[space]
                    rooms.pop(i)
            else:
                space, first = capacity, made
                n = -(-left // (capacity // length))
                made += n
            per = space // length
            full, rest = divmod(left, per) if left < n * per else (n, 0)
            took = full * per + rest
            rows.append((length, rank, rank + took, first, per, capacity - space))
            add(space - per * length, first, full)
            if full < n:
                if rest:
                    add(space - rest * length, first + full, 1)
                add(space, first + full + bool(rest), n - full - bool(rest))
            rank += took
            left -= took
    return rows


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every document.

    Null and empty texts are the end id alone, one piece of length 1. Repeated
    rows are packed each for itself; ties in length go by storing order; an
    empty table gives no rows; columns other than doc_id and text are not
    read. The plan is sent to every task: it has a few rows for each length,
    at most ``capacity`` lengths, whatever the number of documents.
    """
    rows = common.numbered(pieces(docs, tokenizer, capacity), "pieces")
    return placed(rows, capacity)


def placed(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``numbered`` pieces with their sequence_id and offset."""
    spark = rows.sparkSession
    counts = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}  # at most ``capacity`` rows
    spots = spark.createDataFrame(
        plan(counts, capacity), "length long, _lo long, _hi long, _first long, _per long, _at long"
    )
    ranked = common.rank_within(rows, "length", "_rank")
    at = F.col("_rank") - F.col("_lo")
    return (
        ranked.join(F.broadcast(spots), (ranked["length"] == spots["length"]) & (F.col("_rank") >= F.col("_lo")) & (F.col("_rank") < F.col("_hi")))
        .drop(spots["length"])
        .withColumn("sequence_id", F.col("_first") + F.floor(at / F.col("_per")).cast("long"))
        .withColumn("offset", F.col("_at") + at % F.col("_per") * F.col("length"))
        .select(*[c for c in rows.columns if c != "_row"], "sequence_id", "offset")
    )


def sequences(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids array<int> (at most ``capacity`` each), doc_ids of the pieces in order."""
    rows = placed(common.numbered(pieces(docs, tokenizer, capacity, with_ids=True), "pieces"), capacity)
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "ids")))

    @F.arrow_udf("array<int>")
    def numbers(raw: pa.Array) -> pa.Array:
        return pa.array([np.frombuffer(x, "<i4") for x in raw.to_pylist()], pa.list_(pa.int32()))

    whole = rows.groupBy("sequence_id").agg(parts.alias("_p")).withColumn("_raw", F.aggregate("_p", F.lit(b""), lambda a, p: F.concat(a, p["ids"])))
    return whole.select("sequence_id", numbers("_raw").alias("ids"), F.col("_p.doc_id").alias("doc_ids"))

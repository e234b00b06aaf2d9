"""Language identification with string kernels.

Blended-spectrum presence kernel: two texts are as alike as the number of
character 1-, 2- and 3-grams that both hold, over the root of the product of
their own numbers. Nystroem features from landmark texts, one-versus-rest
kernel ridge regression on them, and scores by matrix products over batches.
N-grams are hashed to ``BUCKETS`` places for each length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtline.llm import common

ORDERS = 3
BUCKETS = 1 << 16
LETTER = re.compile(r"[^\W\d_]")
#: Texts in one matrix product.
ROWS = 64
UNKNOWN = "und"


def ngrams(text: str, seen: np.ndarray) -> np.ndarray:
    """Sorted places of the n-grams in the whole ``text``; ``seen`` is a false scratch mask, left false."""
    a = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    code = a.copy()
    for n in range(ORDERS):
        if len(a) <= n:
            break
        if n:
            code = code[:-1] * np.uint64(1_000_003) + a[n:]
        seen[((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.int64) + n * BUCKETS] = True
    found = np.flatnonzero(seen)
    seen[found] = False
    return found


class Model:
    """Landmark n-grams and ridge weights; small enough to send to every task."""

    def __init__(self, langs: list[str], place: np.ndarray, landmarks: np.ndarray, weights: np.ndarray):
        self.langs, self.place, self.landmarks, self.weights = langs, place, landmarks, weights

    def scores(self, texts: list[np.ndarray]) -> np.ndarray:
        """One row of scores for each set of n-grams: presence x landmarks x weights."""
        presence = np.zeros((len(texts), self.landmarks.shape[0]), np.float32)
        for row, found in zip(presence, texts, strict=True):
            at = self.place[found]
            row[at[at >= 0]] = 1
        kernel = presence @ self.landmarks
        kernel /= np.sqrt(np.maximum([len(x) for x in texts], 1))[:, None]
        return kernel @ self.weights

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score (0 to 1) of each text; ``und`` and 0 without a letter or without any learned language."""
        langs, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        seen = np.zeros(ORDERS * BUCKETS, bool)
        rows = [i for i, t in enumerate(texts) if self.langs and t and LETTER.search(t)]
        for at in range(0, len(rows), ROWS):
            part = rows[at : at + ROWS]
            s = self.scores([ngrams(texts[i], seen) for i in part])
            best = s.argmax(1)
            for i, b, v in zip(part, best, s[np.arange(len(part)), best], strict=True):
                langs[i], score[i] = self.langs[b], min(1.0, max(0.0, (1 + float(v)) / 2))
        return langs, score


def train(examples: list[tuple[str, np.ndarray]], landmarks_per_lang: int = 16, ridge: float = 0.1) -> Model:
    """Fit on (language, n-gram places); the first texts of each language are its landmarks."""
    langs = sorted({lang for lang, _ in examples})
    marks = [x for lang in langs for x in [x for y, x in examples if y == lang][:landmarks_per_lang]]
    place = np.full(ORDERS * BUCKETS, -1, np.int64)
    if not marks:
        return Model([], place, np.zeros((0, 0), np.float32), np.zeros((0, 0), np.float32))
    used = np.unique(np.concatenate(marks))
    place[used] = np.arange(len(used))
    m = np.zeros((len(used), len(marks)), np.float32)
    for j, x in enumerate(marks):
        m[place[x], j] = 1
    m /= np.sqrt(np.maximum(m.sum(0), 1))
    model = Model(langs, place, m, np.eye(len(marks), dtype=np.float32))
    kernel = model.scores([x for _, x in examples])
    values, vectors = np.linalg.eigh((m.T @ m).astype(np.float64))
    keep = values > 1e-6 * values.max()
    root = (vectors[:, keep] / np.sqrt(values[keep])) @ vectors[:, keep].T
    feature = kernel @ root
    target = np.array([[1.0 if lang == y else -1.0 for lang in langs] for y, _ in examples])
    solved = np.linalg.solve(feature.T @ feature + ridge * np.eye(feature.shape[1]), feature.T @ target)
    model.weights = (root @ solved).astype(np.float32)
    return model


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = np.zeros(ORDERS * BUCKETS, bool)
    for b in common.pieces(batches):
        rows = [r for r in b.to_pylist() if r["text"] and LETTER.search(r["text"])]
        yield pa.RecordBatch.from_pydict(
            {"doc_id": [r["doc_id"] for r in rows], "lang": [r["lang"] for r in rows], "grams": [ngrams(r["text"], seen).astype(np.int32) for r in rows]},
            schema=pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("grams", pa.list_(pa.int32()))]),
        )


def held_out() -> F.Column:
    """Whether a document is kept from learning; a null doc_id is never learned from, nor counted as held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, per_lang: int = 200, landmarks_per_lang: int = 16, ridge: float = 0.1) -> Model:
    """Learn from at most ``per_lang`` documents of each language, none of them held out.

    The sample is the documents with the lowest key hashes; what reaches the
    driver is their n-gram places, at most ``ORDERS * BUCKETS`` numbers each.
    """
    common.short_batches(docs.sparkSession)
    free = docs.filter(~held_out() & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    ids = common.sample_ids(free, per_lang, by="lang")  # at most per_lang for each language: bounded
    # of rows that repeat a doc_id, the least text: the same in every run
    texts = free.join(F.broadcast(ids), "doc_id", "left_semi").groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
    rows = texts.select("doc_id", "lang", "text").mapInArrow(_examples, "doc_id long, lang string, grams array<int>").collect()
    rows.sort(key=lambda r: (r["lang"], r["doc_id"]))
    return train([(r["lang"], np.array(r["grams"], np.int64)) for r in rows], landmarks_per_lang, ridge)


def predictor(spark: SparkSession, model: Model):
    """A function of a text column giving struct<lang_pred, score>."""
    sent = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def language(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            langs, score = [], []
            for at in range(0, len(texts), common.ARROW_ROWS):
                some, scores = sent.value.predict(texts[at : at + common.ARROW_ROWS].to_pylist())
                langs += list(some)
                score += list(scores)
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(score, pa.float64())], ["lang_pred", "score"])

    return language


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row, read from whole texts.

    Null, empty and letterless texts are ``und`` with score 0, as is every
    text where nothing could be learned. Repeated rows get equal answers, an
    empty table none; of all columns only doc_id, text and, to learn, lang
    are read, and other columns may have any name.
    """
    common.short_batches(docs.sparkSession)
    language = predictor(docs.sparkSession, model or fit(docs))
    return docs.select("doc_id", held_out().alias("held_out"), language("text").alias("_p")).select(
        "doc_id", "held_out", "_p.lang_pred", "_p.score"
    )


def keep_known(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The rows of ``docs`` whose language is known (not ``und``), all columns unchanged.

    Where nothing could be learned, the rows whose text has a letter.
    """
    common.short_batches(docs.sparkSession)
    model = model or fit(docs)
    language = predictor(docs.sparkSession, model)
    name = "_language"
    while name in docs.columns:
        name += "_"
    if not model.langs:

        @F.arrow_udf("boolean")
        def lettered(texts: pa.Array) -> pa.Array:
            return pa.array([bool(t and LETTER.search(t)) for t in texts.to_pylist()], pa.bool_())

        return docs.withColumn(name, lettered(docs["text"])).filter(F.col(name)).drop(name)
    return docs.withColumn(name, language(docs["text"])).filter(F.col(name)["lang_pred"] != UNKNOWN).drop(name)

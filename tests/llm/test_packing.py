import collections
import random
import zlib

import numpy as np
from tokenizers import Tokenizer

from courtline.llm import packing
from courtline.llm.catalog import tokenizer_path
from courtline.llm.common import table
from llm_util import collected, empty, odd_documents


def plain(texts):
    t = Tokenizer.from_file(tokenizer_path())
    return [t.encode(x or "", add_special_tokens=False).ids + [1] for x in texts]


def test_ids_are_the_tokenizers():
    rng = random.Random(0)
    alphabet = ["the", "don't", "Élan", "é", "́", "ß", "İ", "x1y", "...", "\x01", "\x1c", " ", " ", "<|endoftext|>", "<|", "日本", "🙂", "\n", "\t", " ", " ", " ", "\r\n", "\x85", "Σ", "ς", "'s", "1234", "퟿"]
    texts = [None, "", " ", *("".join(rng.choice(alphabet) for _ in range(rng.randrange(25))) for _ in range(3000))]
    assert [np.frombuffer(x, "<u4").tolist() for x in packing.encode(texts, tokenizer_path())] == plain(texts)


def check(spark, docs, capacity):
    docs_ = docs.collect()
    rows = packing.pack(docs, tokenizer_path(), capacity).collect()
    per = collections.defaultdict(list)
    for r in rows:
        per[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    want = collections.defaultdict(list)
    for d, ids in zip(docs_, plain([d["text"] for d in docs_]), strict=True):
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            want[d["doc_id"]].append((k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert {k: sorted(v) for k, v in per.items()} == {k: sorted(v) for k, v in want.items()}
    gapless(rows, capacity)
    return rows


def gapless(rows, capacity):
    seqs = collections.defaultdict(list)
    for r in rows:
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in seqs.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= capacity
    return len(seqs)


def test_documents(spark):
    rows = check(spark, table(spark, "/root/testdata/sf0.01", "documents"), 4096)
    least = -(-sum(r["length"] for r in rows) // 4096)
    assert len({r["sequence_id"] for r in rows}) <= 1.02 * least + 1


def test_small_capacity_and_odd_rows(spark):
    check(spark, odd_documents(spark), 64)
    assert packing.pack(empty(spark), tokenizer_path()).count() == 0


def test_plan_against_best_fit_one_by_one():
    rng = random.Random(4)
    for _ in range(150):
        cap = rng.choice([10, 32, 100])
        counts = {rng.randint(1, cap): rng.randint(1, 60) for _ in range(rng.randrange(12))}
        rows = packing.plan(counts, cap)
        placed = []
        for length, lo, hi, first, per, at in rows:
            placed += [{"length": length, "rank": r, "sequence_id": first + (r - lo) // per, "offset": at + (r - lo) % per * length} for r in range(lo, hi)]
        assert collections.Counter(p["length"] for p in placed) == collections.Counter(counts)
        assert len({(p["length"], p["rank"]) for p in placed}) == len(placed)
        used = gapless(placed, cap)
        room = []
        for n in sorted((x for x, c in counts.items() for _ in range(c)), reverse=True):
            fit = [i for i, r in enumerate(room) if r >= n]
            if fit:
                room[min(fit, key=lambda i: room[i])] -= n
            else:
                room.append(cap - n)
        assert used == len(room)


def test_plan_does_not_grow_with_the_corpus():
    rng = random.Random(1)
    counts = {n: rng.randint(1, 50) for n in range(1, 4097)}
    a, b = len(packing.plan(counts)), len(packing.plan({n: 1000 * c for n, c in counts.items()}))
    assert b < 1.5 * a + 100


def test_sequences(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    rows = packing.sequences(docs, tokenizer_path(), 512).collect()
    texts = [r["text"] for r in docs.collect()]
    assert sum(len(r["ids"]) for r in rows) == sum(map(len, plain(texts)))
    assert max(len(r["ids"]) for r in rows) <= 512


def test_workers_give_memory_back(monkeypatch, spark):
    called = []
    monkeypatch.setattr(packing.common, "give_back", lambda: called.append(1))
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: (list(run(iter(self.toArrow().to_batches()))), self.selectExpr("doc_id", "1 as ids"))[1])
    packing.pieces(docs, tokenizer_path())
    assert len(called) == 2


def test_new_words_run_the_merges_alone(monkeypatch):
    """Plain letters, and marks after letters, are learned without the whole tokenizer, once for all words they follow."""
    known = packing.WordIds(tokenizer_path())
    monkeypatch.setitem(packing._VOCABULARIES, tokenizer_path(), known)
    seen = []
    whole = known._whole
    monkeypatch.setattr(known, "_whole", lambda text: seen.append(text) or whole(text))
    texts = ["Réseau, Éclair! thère. abc$$$ abc,&&& x1. Œuvre; end?", "the end, there."]
    got = [np.frombuffer(x, "<u4").tolist() for x in packing.encode(texts, tokenizer_path())]
    assert got == plain(texts)
    assert not any(w in t for t in seen for w in ("réseau", "éclair", "abc", "there", "œuvre"))
    assert {"réseau", "abc", "$$$", ",&&&", "there", "."} <= known.keys() and "there." not in known


def test_marks_of_any_sort():
    rng = random.Random(2)
    alphabet = ["a", "é", "ß", "x1", "9", "'s", "'", ",", ".", "...", "!", "&&", "$", "(", ")", "-", "_", "́", "̸", "Σ", ";", "<", "=", " ", " ", "\n", " ", "×", "ª"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(30))) for _ in range(4000)]
    assert [np.frombuffer(x, "<u4").tolist() for x in packing.encode(texts, tokenizer_path())] == plain(texts)

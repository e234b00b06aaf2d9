import hashlib
import random
import zlib

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from courtline.llm import catalog, runs
from llm_util import collected, empty, odd_documents

SF = "/root/testdata/sf0.01"


def brute(words):
    """Every lag's stretches of equal words, kept where no smaller period fits."""
    n, out = len(words), []
    for p in range(1, n // 3 + 1):
        i = p
        while i < n:
            if words[i] != words[i - p]:
                i += 1
                continue
            first = i
            while i < n and words[i] == words[i - p]:
                i += 1
            stretch = words[first - p : i]
            if len(stretch) >= max(24, 3 * p) and not any(stretch[q:] == stretch[:-q] for q in range(1, p)):
                out.append((first - p, len(stretch), p))
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    import re

    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    n = len(words)
    if n and doc_id is not None and (h := zlib.crc32(str(doc_id).encode())) % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute(words)
    gone = {i for s, k, p in found for i in range(s + p, s + k)}
    best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest()
    return {
        "doc_id": doc_id,
        "n_runs": len(found),
        "start": best and best[0],
        "length": best and best[1],
        "period": best and best[2],
        "exponent_milli": best and 1000 * best[1] // best[2],
        "runs_sha256": sha("".join(f"{s},{k},{p}\n" for s, k, p in found)),
        "collapsed_sha256": sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    }


@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=40), st.integers(1, 90)), max_size=5))
@settings(max_examples=400, deadline=None)
def test_runs_equal_brute_force(parts):
    words = [w for loop, n in parts for w in (loop * n)[:n]]
    assert runs.runs(words) == brute(words)


def test_runs_within_runs():
    """Squares of squares, powers that touch, periods at the bounds of the levels."""
    rng = random.Random(3)
    for _ in range(300):
        loop = [rng.randrange(2) for _ in range(rng.choice([1, 2, 8, 15, 16, 17, 31, 32, 33, 40, 64, 65]))]
        inner = loop * rng.randrange(2, 5) + [7] * rng.randrange(2)
        words = [rng.randrange(2) for _ in range(rng.randrange(20))] + inner * rng.randrange(1, 5) + loop[: rng.randrange(9)]
        assert runs.runs(words) == brute(words)


def test_shortest_and_longest():
    assert runs.runs(list("a" * 23)) == [] and runs.runs(list("a" * 24)) == [(0, 24, 1)]
    assert runs.runs(list("abcdefgh" * 3)) == [(0, 24, 8)]
    assert runs.runs(list(range(100)) * 3) == [(0, 300, 100)] and runs.runs((list(range(100)) * 3)[:-1]) == []
    assert runs.runs(["x"] * 300_000) == [(0, 300_000, 1)]  # all words alike: linear
    assert runs.runs(list(range(40_000)) * 5) == [(0, 200_000, 40_000)]


def test_overlapping_runs_collapse_once():
    words = list("ab" * 20 + "b" * 40)
    found = runs.runs(words)
    gone = {i for s, k, p in found for i in range(s + p, s + k)}
    assert len(found) == 2 and runs.collapsed(words, found) == [w for i, w in enumerate(words) if i not in gone]


def test_query(spark):
    rows = duckdb.connect().sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    rows = {d: t for d, t in rows}
    got = collected(catalog.QUERIES["op12_runs"](spark, SF), "doc_id")
    assert [r["doc_id"] for r in got] == sorted(rows)
    for r in got:
        if len((rows[r["doc_id"]] or "").split()) < 1500:
            assert r == brute_row(r["doc_id"], rows[r["doc_id"]])
    assert sum(r["n_runs"] > 0 for r in got) > 50


def test_odd_rows(spark):
    loop = " ".join(f"w{i}" for i in range(30))
    extra = [(3, f"{loop} " * 5, "en", "a"), (3, f"{loop} " * 5, "en", "a"), (None, "la " * 30, "en", "a"), (20, "x\x1cy \x85 z\xa0 " * 20, "en", "a")]
    df = odd_documents(spark, extra)
    got = sorted((r.asDict() for r in runs.periodic(df).collect()), key=str)
    texts = [(r["doc_id"], r["text"]) for r in df.collect()]
    small = [(d, t) for d, t in texts if len(t or "") < 5000]
    assert len(got) == len(texts)
    for d, t in small:
        assert brute_row(d, t) in got
    assert runs.periodic(empty(spark)).count() == 0


def test_nothing_is_shuffled(spark):
    plan = catalog.QUERIES["op12_runs"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "ReadSchema: struct<doc_id:bigint,text:string>" in plan


@pytest.mark.parametrize("n", [0, 1, 24])
def test_looped_ends(n):
    words = [str(i) for i in range(n)]
    ids = [d for d in range(300) if zlib.crc32(str(d).encode()) % 10 == 0]
    assert all(len(runs.looped(words, d)) == n for d in ids)

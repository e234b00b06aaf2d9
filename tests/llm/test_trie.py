import hashlib
import random
import zlib

import pytest

from courtline.llm import catalog, trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, _row string, n_turns int"
SF = "/root/testdata/sf0.01"


def brute(rows):
    """rows: (conv_id, turn, role, text)."""
    told = {}
    for c, t, r, x in rows:
        if c is not None:
            told.setdefault(c, []).append((t is not None, t or 0, hashlib.md5(f"{len(r or '')}:{r or ''}{x or ''}".encode()).digest(), (r or "", x or "")))
    told = {c: [x[3] for x in sorted(v, key=lambda x: x[:3])] for c, v in told.items()}
    paths = {}
    for c, own in told.items():
        h = zlib.crc32(str(c).encode()) % 6
        paths[c] = told.get(c - c % 100, [])[:h] + own[h:]
    members = {}
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members.setdefault(tuple(p[:d]), []).append(c)
    saved, leaves, children = dict.fromkeys(members, 0), dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for v in members:
        if v:
            children[v[:-1]] += 1
    for v, m in members.items():
        for d in range(len(v) + 1):
            saved[v[:d]] += (len(m) - 1) * len(v[-1][1]) if v else 0
            leaves[v[:d]] += children[v] == 0
    return sorted(
        (
            min(m), len(v), min(members[v[:-1]]) if v else None, len(m), children[v], leaves[v], saved[v],
            hashlib.sha256(",".join(map(str, sorted(c for c in m if len(paths[c]) == len(v)))).encode()).hexdigest(),
        )
        for v, m in members.items()
    )


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def check(spark, rows):
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA)
    got = trie.conversation_trie(df)
    assert got.columns == COLUMNS
    got = sorted(map(tuple, got.collect()))
    assert got == brute(rows)
    return got


def test_documented_table(spark):
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    got = sorted(map(tuple, catalog.QUERIES["op11_trie"](spark, SF).select(*COLUMNS).collect()))
    assert got == brute(rows)


def test_random_shared_and_long(spark):
    """Few texts, so that prefixes are shared across the blocks' bounds, and conversations that diverge far down."""
    rng = random.Random(11)
    rows = []
    for c in [*range(40), *range(97, 140), 1000, 1001, 65_535, 65_536, 65_537, 200_000]:
        n = rng.choice([1, 2, 3, 7, 8, 9, 16, 17, 33])
        rows += [(c, t, rng.choice("ab") if rng.random() < 0.05 else "u", "é" * (t % 3)) for t in range(n)]
    rng.shuffle(rows)
    check(spark, rows)


def test_odd_rows(spark):
    rows = [
        (0, None, "u", "first"), (0, None, "u", "first"), (0, 0, None, None), (0, 0, "", ""), (0, 3, "u", "last"),
        (None, 0, "u", "nobody's"), (None, None, None, None), (5, 1, "ab", "c"), (6, 1, "a", "bc"), (7, 2, "u", None),
        (301, 0, "u", "x" * 300_000), (302, 0, "u", "x" * 300_000), (302, 0, "u", "x" * 300_000), (-5, 0, "u", "below"), (-100, 1, "u", "z"),
    ]
    check(spark, rows)
    check(spark, [(9, 0, "u", "alone")])
    # conversations whose first turns go and whose group has no first one: only a root, of members without turns
    short = [c for c in range(101, 160) if zlib.crc32(str(c).encode()) % 6 > 0][:5]
    assert len(check(spark, [(c, 0, "u", str(c)) for c in short])) == 1
    assert check(spark, []) == []


def test_hot_conversation_and_copies(spark):
    """One conversation with half of all turns, and one text that a third of the conversations are."""
    rows = [(3, None, "u", str(t % 7)) for t in range(9_000)] + [(c, t, "u", f"copy {t}") for c in range(1000, 2000) for t in range(6)]
    rows += [(c, 0, "u", f"own {c}") for c in range(4000, 4500)]
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA).repartition(7)
    got = sorted(map(tuple, trie.conversation_trie(df).collect()))
    assert got == quick(rows)


def quick(rows):
    """brute with the long conversation's sums made from its end."""
    told = {}
    for c, t, r, x in rows:
        told.setdefault(c, []).append((t is not None, t or 0, hashlib.md5(f"{len(r)}:{r}{x}".encode()).digest(), (r, x)))
    told = {c: [x[3] for x in sorted(v, key=lambda x: x[:3])] for c, v in told.items()}
    paths = {}
    for c, own in told.items():
        h = zlib.crc32(str(c).encode()) % 6
        paths[c] = told.get(c - c % 100, [])[:h] + own[h:]
    nodes = [{"up": None, "next": {}, "m": [], "ends": [], "size": 0, "depth": 0}]
    for c in sorted(paths):
        at = 0
        nodes[0]["m"].append(c)
        for t in paths[c]:
            if t not in nodes[at]["next"]:
                nodes.append({"up": at, "next": {}, "m": [], "ends": [], "size": len(t[1]), "depth": nodes[at]["depth"] + 1})
                nodes[at]["next"][t] = len(nodes) - 1
            at = nodes[at]["next"][t]
            nodes[at]["m"].append(c)
        nodes[at]["ends"].append(c)
    for v in reversed(nodes):  # children come after their parents
        v["saved"] = (len(v["m"]) - 1) * v["size"] + sum(nodes[k]["saved"] for k in v["next"].values())
        v["leaves"] = sum(nodes[k]["leaves"] for k in v["next"].values()) or 1
    return sorted(
        (
            v["m"][0], v["depth"], None if v["up"] is None else nodes[v["up"]]["m"][0], len(v["m"]), len(v["next"]), v["leaves"], v["saved"],
            hashlib.sha256(",".join(map(str, v["ends"])).encode()).hexdigest(),
        )
        for v in nodes
    )


def test_one_rollup_without_cross_joins(spark):
    plan = catalog.QUERIES["op11_trie"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" in plan and "Cartesian" not in plan and "Join Cross" not in plan


@pytest.mark.parametrize("n", [1, 3])
def test_digests_stream_over_pieces(n):
    import pyarrow as pa

    rows = [(0, 1, 2, "1,2"), (0, 1, 2, "65536"), (0, 1, 2, "131072,131073"), (3, 4, 5, "7")]
    batches = [pa.RecordBatch.from_pylist([dict(zip(["depth", "a", "b", "ids"], r, strict=True)) for r in rows[i : i + n]]) for i in range(0, len(rows), n)]
    got = [tuple(r.values()) for b in trie._sha256(iter(batches)) for r in b.to_pylist()]
    assert got == [(0, 1, 2, hashlib.sha256(b"1,2,65536,131072,131073").hexdigest()), (3, 4, 5, hashlib.sha256(b"7").hexdigest())]

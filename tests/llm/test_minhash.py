import random

from courtline.llm import components, minhash
from courtline.llm.common import table
from llm_util import collected, empty, odd_documents


def sets(text, width):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def brute(rows, width, percent):
    """Component ids by testing all pairs that share a shingle."""
    ids = [d for d, _ in rows]
    s = [sets(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    at = {}
    for i, x in enumerate(s):
        for y in x:
            at.setdefault(y, []).append(i)
    for i, x in enumerate(s):
        for j in {j for y in x for j in at[y] if j < i}:
            both = len(x & s[j])
            if 100 * both >= percent * (len(x) + len(s[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        least[find(i)] = min(d, least.get(find(i), d))
    return {d: (len(s[i]), least[find(i)]) for i, d in enumerate(ids)}


def check(spark, df, width, percent):
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    want = brute(rows, width, percent)
    got = collected(minhash.classes(df, width, percent), "doc_id")
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]], r
        assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_against_brute_force(spark):
    check(spark, table(spark, "/root/testdata/sf0.01", "documents"), 3, 85)


def test_pipeline_parameters_against_brute_force(spark):
    check(spark, table(spark, "/root/testdata/sf0.001", "documents"), 5, 80)


def test_large_group_of_near_copies(spark):
    """One template with few to many edits: a hot bucket whose members are only partly linked."""
    rng = random.Random(3)
    base = [f"w{rng.randrange(400)}" for _ in range(90)]
    rows = []
    for i in range(400):
        w = list(base)
        for _ in range(rng.randrange(9)):
            w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    check(spark, spark.createDataFrame(rows, "doc_id long, text string"), 3, 85)


def test_odd_rows(spark):
    got = collected(minhash.classes(odd_documents(spark), 3, 85), "doc_id")
    assert len(got) == 13
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert by[1]["component_id"] == by[2]["component_id"] == 1 and by[1]["kept"] and not by[2]["kept"]
    assert all(by[d]["n_shingles"] == 0 and by[d]["component_id"] == d and by[d]["kept"] for d in (3, 4, 5))
    assert by[9]["n_shingles"] == 1
    assert all(not r["kept"] for r in got if r["doc_id"] is None)
    assert minhash.classes(empty(spark)).count() == 0


def test_keep_one(spark):
    docs = odd_documents(spark, extra=[(20, "quite another text of its own kind here", "en", "z"), (20, "quite another text of its own kind here", "en", "z")])
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.select("doc_id").collect())
    assert [d for none, d in ids if not none] == [1, 3, 4, 5, 6, 7, 8, 9, 11, 20]
    assert sum(none for none, _ in ids) == 2
    assert minhash.keep_one(empty(spark)).count() == 0


def test_sketch_estimates_likeness():
    import numpy as np

    rng = np.random.default_rng(0)
    for n in (1, 3, 40, 2000):
        a = rng.integers(0, 2**63, 2 * n).astype(np.uint64)
        x, y = np.unique(a[: int(1.8 * n) or 1]), np.unique(a[int(0.2 * n) :])
        want = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
        same = (minhash.sketch(x, 2000) == minhash.sketch(y, 2000)).mean()
        assert abs(same - want) < 0.06, (n, same, want)
        assert (minhash.sketch(x) == minhash.sketch(x[::-1].copy())).all()


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(90), rng.randrange(90)) for _ in range(50)] + [(500, x) for x in range(501, 600)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_repeated_ids_with_different_texts(spark):
    """One key on many clean texts, and on a copy of another document: every distinct text stays once."""
    rng = random.Random(8)
    text = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(60))
    clean, copied, negative = [text() for _ in range(30)], text(), text()
    rows = [*[(7, t) for t in clean], (7, clean[0]), (3, copied), (7, copied + " end"), (7, ""), (-5, negative), (9, negative + " end"), (12, clean[4] + " end")]
    kept = minhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    want = [*[(7, t) for t in clean], (3, copied), (7, ""), (-5, negative)]
    assert sorted(map(tuple, kept.collect())) == sorted(want)
    got = minhash.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r["component_id"] for r in got) == sorted([7] * 33 + [3] * 2 + [-5] * 2)


def _far_clusters(spark, n, clusters):
    """Members that differ from the pivot in a block that their cluster shares and a few items of their own."""
    sets_, group = [(0, list(range(200)))], []
    for c in range(clusters):
        for i in range(n):
            me = 1 + c * n + i
            block = range(10_000 * (c + 1), 10_000 * (c + 1) + 60)
            sets_.append((me, [*range(140), *block, *(10**7 + 3 * me + k for k in range(3))]))
            group.append((0, me, me))
    return spark.createDataFrame(group, "pivot long, id long, c long"), spark.createDataFrame(sets_, "id long, items array<long>")


def test_clusters_far_from_the_pivot_are_linear(spark, monkeypatch):
    """All members of a cluster share the items that set them apart from the pivot: pairs grow with the members, and all are linked."""
    made = []
    met = minhash._met

    def counted(pairs, percent):
        out = met(pairs, percent)
        made.append(out.count())
        return out

    monkeypatch.setattr(minhash, "_met", counted)
    total = {}
    for n in (50, 100):
        made.clear()
        group, items = _far_clusters(spark, n, 3)
        links = minhash._beyond(group, items, 80)
        got = components.components(links).groupBy("component").count().collect()
        assert sorted(r["count"] for r in got) == [n] * 3
        total[n] = sum(made)
    assert total[50] <= 4 * 150 and total[100] <= 2.2 * total[50]


def test_beyond_against_brute_force(spark):
    """Random sets around a pivot, linked or not, in small and crowded groups."""
    rng = random.Random(4)
    for size, crowd in ((70, 100), (45, 5)):
        sets_ = {0: set(range(100))}
        for i in range(1, size):
            s = set(sets_[rng.choice([0, *range(max(1, i - 5), i)])])
            s -= set(rng.sample(sorted(s), rng.randrange(12)))
            s |= {rng.randrange(100, 160) for _ in range(rng.randrange(12))}
            sets_[i] = s
        want = {(i, j) for i in sets_ for j in sets_ if 0 < j < i and 100 * len(sets_[i] & sets_[j]) >= 80 * len(sets_[i] | sets_[j])}
        near = [i for i in sets_ if i and 100 * len(sets_[i] & sets_[0]) >= 80 * len(sets_[i] | sets_[0])]
        group = spark.createDataFrame([(0, i, 0 if i in near else i) for i in sets_ if i], "pivot long, id long, c long")
        items = spark.createDataFrame([(i, sorted(s)) for i, s in sets_.items()], "id long, items array<long>")
        old, minhash.CROWD = minhash.CROWD, crowd
        links = minhash._beyond(group, items, 80)
        minhash.CROWD = old
        edges = links.union(spark.createDataFrame([(i, 0) for i in near], "a long, b long"))
        got = {r["node"]: r["component"] for r in components.components(edges).collect()}
        whole = components.components(spark.createDataFrame([*want, *((i, 0) for i in near)], "a long, b long"))
        assert got == {r["node"]: r["component"] for r in whole.collect()}


def test_settings_are_put_back(spark):
    """Those of one operator are restored; the number of rows in a batch is a default that a session's own setting outranks."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, rows = {k: spark.conf.get(k, None) for k in minhash.RUNTIME_FILTER}, spark.conf.get(key)
    spark.conf.set(key, "777")
    try:
        minhash.keep_one(odd_documents(spark)).count()
        assert before == {k: spark.conf.get(k, None) for k in before} and spark.conf.get(key) == "777"
    finally:
        spark.conf.set(key, rows)

import collections
import math
import re

from pyspark.sql import functions as F

from courtline.llm import licenses
from courtline.llm.common import table
from llm_util import collected, empty, odd_documents


def words(text):
    return {w for w in re.split("[^a-z0-9]+", "".join(c.lower() if c.isascii() else c for c in text)) if w}


def sequence(text):
    return [w for w in re.split("[^a-z0-9]+", "".join(c.lower() if c.isascii() else c for c in text or "")) if w]


def anchors_of(v, weight, least):
    """A template's weightier words: any words without one of these weigh too little."""
    order = sorted(v, key=lambda w: (-weight[w], w))
    norm = sum(weight[w] ** 2 for w in v)
    for i in range(len(order)):
        if sum(weight[w] ** 2 for w in order[i:]) < least**2 * norm * (1 - 1e-9):
            return set(order[:i])
    return set(order)


def brute(files, templates=licenses.NOTICES, least=0.75):
    """Own licences by comparing every passage (line, run of a template's length that holds its anchors, whole licence file) with every template."""
    n = len(files)
    vocab = {k: words(t) for k, t in templates.items()}
    held = collections.Counter(w for _, _, t in files for w in words(t or ""))
    weight = collections.defaultdict(lambda: math.log(1 + n) + 1, {w: math.log((1 + n) / (1 + c)) + 1 for w, c in held.items()})
    norms = {k: math.sqrt(sum(weight[x] ** 2 for x in v)) for k, v in vocab.items()}
    anchors = {k: anchors_of(v, weight, least) for k, v in vocab.items()}
    by_length = {}
    for k, t in templates.items():
        by_length.setdefault(len(sequence(t)), set()).update(anchors[k])
    known = set().union(*anchors.values())
    own = {}
    for f, path, text in files:
        seq = sequence(text)
        # what a passage has in common with a template, its file has too
        may = [k for k, v in vocab.items() if sum(weight[x] ** 2 for x in set(seq) & v) >= (least**2 - 1e-9) * norms[k] ** 2]
        found = [(1.0, 2, x) for x in re.findall(licenses.IDENTIFIER, text or "")]
        parts = []
        if may:
            parts = [words(line) for line in (text or "").split("\n")]
            if path is not None and re.search(licenses.LICENSE_FILE.replace("(?i)", ""), path, re.I):
                parts.append(set(seq))
            for k, mine in by_length.items():
                parts += [set(r) for r in (seq[i : i + k] for i in range(max(1, len(seq) - k + 1))) if mine & set(r)]
        for w in parts:
            if w & known:
                norm = math.sqrt(sum(weight[x] ** 2 for x in w))
                for k in may:
                    s = sum(weight[x] ** 2 for x in w & vocab[k]) / (norm * norms[k])
                    if s >= least:
                        found.append((round(s, 9), int("/" in k), k.partition("/")[0]))
        if found:
            own[f] = max(found + [own[f]] if f in own else found)
    given = {}
    for f, path, _ in files:
        if path is not None and f in own and re.search(licenses.LICENSE_FILE.replace("(?i)", ""), path, re.I):
            d = path.rpartition("/")[0]
            given[d] = min(given.get(d, (0, "~")), (-own[f][0], own[f][2]))
    out = []
    for f, path, _ in files:
        d, found = (path.rpartition("/")[0] if path is not None else None), None
        while d is not None and f not in own:
            if d in given:
                found = (d, given[d][1])
                break
            d = d.rpartition("/")[0] if d else None
        out.append((f, path, own.get(f, (None,) * 3)[2], *(found or (None, None)), own[f][2] if f in own else found and found[1]))
    return out


def check(files):
    rows = [(r["file_id"], r["path"], r["text"]) for r in files.collect()]
    got = [(r["file_id"], r["path"], r["own_license"], r["from_dir"], r["inherited"], r["license"]) for r in licenses.scan(files).collect()]
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(got, key=key) == sorted(brute(rows), key=key)
    return got


def test_documents(spark):
    got = check(licenses.as_files(table(spark, "/root/testdata/sf0.01", "documents")))
    assert any(r[2] for r in got)


def test_inheritance(spark):
    mit, gpl = licenses.TEMPLATES["MIT"], licenses.TEMPLATES["GPL-3.0"]
    rows = [
        (1, "LICENSE", mit), (2, "a/b/LICENSE.txt", "x\n" + gpl), (3, "a/b/c/d.py", "code"), (4, "a/e.py", "code"),
        (5, "a/b/own.py", "Licensed under the Apache License, Version 2.0."), (6, None, "text"), (7, "a/b/c/copying", "no licence in here"),
        (8, "top", None), (9, "a/b/", ""), (None, "a/x", "text"), (4, "a/e.py", "code"),
        *[(100 + i, f"z/{i}", f"filler number{i}") for i in range(30)],
    ]
    got = check(spark.createDataFrame(rows, "file_id long, path string, text string"))
    by = {r[0]: r for r in got}
    assert by[3][5] == "GPL-3.0" and by[4][5] == "MIT" and by[5][5] == "Apache-2.0" and by[6][5] is None and by[8][5] == "MIT"


def test_odd_rows(spark):
    check(licenses.as_files(odd_documents(spark)))
    assert licenses.scan(licenses.as_files(empty(spark))).count() == 0


def test_no_python_in_the_plan(spark):
    plan = licenses.scan(licenses.as_files(table(spark, "/root/testdata/sf0.001", "documents")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_notices_over_several_lines(spark):
    rows = [
        (1, "a/LICENSE", "Licensed under the Apache License,\nVersion 2.0."), (2, "a/x.py", "code"),
        (3, "b/x.py", "# This work is licensed under the\n# GNU General Public\n#\n# License, version 3.\nimport os"),
        (4, "c/x.py", "Released\n\nunder the\nMIT\nLicense."), (5, "d/x.py", "the Apache\n" + "filler words\n" * 9 + "License"),
        (6, "e/COPYING", "MIT License:\nreleased as a work\nunder the same"), (7, "e/x.py", "code"),
        *[(100 + i, f"z/{i}", f"the work of number{i} is under version {i}") for i in range(60)],
    ]
    files = spark.createDataFrame(rows, "file_id long, path string, text string")
    by = {r["file_id"]: r["license"] for r in licenses.scan(files).collect()}
    assert [by[i] for i in range(1, 6)] == ["Apache-2.0", "Apache-2.0", "GPL-3.0", "MIT", None]
    assert sum(v is not None for v in by.values()) <= 6


def test_frequencies_of_all_words_are_counted(spark):
    line = "All of it was released under the MIT License as it is and was."
    rows = [(1, "a/x.py", line), *[(100 + i, f"z/{i}", f"all of it was as it is and the other number{i}") for i in range(400)]]
    files = spark.createDataFrame(rows, "file_id long, path string, text string")
    n = len(rows)
    held = {w: sum(w in words(t) for _, _, t in rows) for w in words(line)}
    weight = {w: math.log((1 + n) / (1 + c)) + 1 for w, c in held.items()}
    v = words(licenses.TEMPLATES["MIT"])
    want = math.sqrt(sum(weight[w] ** 2 for w in v) / sum(x**2 for x in weight.values()))
    # as a line: the words of no template are in every file and weigh little
    assert want > 0.75
    one = files.withColumn("text", F.regexp_replace("text", "MIT License", "MIT all License"))
    for r in licenses.own_licenses(one, {"MIT": licenses.TEMPLATES["MIT"]}).collect():
        assert r["license"] == "MIT" and abs(r["score"] - want) < 1e-9
    assert licenses.own_licenses(one, {"MIT": licenses.TEMPLATES["MIT"]}).count() == 1


def test_nearest_of_like_notices(spark):
    names = sorted(licenses.NOTICES)
    rows = [
        *[(i, f"a{i}/LICENSE", licenses.NOTICES[name]) for i, name in enumerate(names)],
        *[(100 + i, f"z/{i}", f"the work is under version 2 and 3 by number{i} of 4 or 1 or 0") for i in range(400)],
    ]
    files = spark.createDataFrame(rows, "file_id long, path string, text string")
    got = {r["file_id"]: (r["license"], r["score"]) for r in licenses.own_licenses(files).collect()}
    assert got == {i: (name.partition("/")[0], 1.0) for i, name in enumerate(names)}


def test_real_licence_files_and_identifiers(spark):
    """Whole texts with a copyright line, titles, headers in comments, identifiers; a text that is none of them."""
    texts = licenses.licence_texts.TEXTS
    comment = lambda t, mark: "\n".join(mark + line for line in t.split("\n"))
    rows = [
        (1, "a/LICENSE", "MIT License\n\nCopyright (c) 2020 Some Body\n\n" + texts["MIT/text"]), (2, "a/src/x.py", "code"),
        (3, "b/LICENSE", "\n" * 3 + " " * 30 + texts["Apache-2.0/title"].replace("\n", "\n" + " " * 20) + "\n1. Definitions.\n" + "some more words of it " * 20),
        (4, "c/x.c", "// SPDX-License-Identifier: MIT\nint main;"), (5, "c/y.c", "/* SPDX-License-Identifier: (GPL-2.0-only OR MIT) */"),
        (6, "d/x.py", comment(texts["GPL-3.0/header"], "# ") + "\nimport os\n" + "other code here\n" * 30), (7, "e/x.py", comment(texts["AGPL-3.0/header"], "# ")),
        (8, "f/COPYING", texts["BSD-2-Clause/text"]), (9, "g/COPYING", "Copyright 2001 Them\n" + texts["BSD-3-Clause/text"]),
        (10, "h/LICENSE", "This is a text about software and the warranty of nobody, and of no licence."), (11, "b/x.py", "code"),
        *[(100 + i, f"z/{i}", f"the words of the file and of number{i} in it, to be or not to be with any other") for i in range(200)],
    ]
    got = check(spark.createDataFrame(rows, "file_id long, path string, text string"))
    by = {r[0]: r[5] for r in got}
    assert [by[i] for i in range(1, 12)] == [
        "MIT", "MIT", "Apache-2.0", "MIT", "GPL-2.0-only", "GPL-3.0", "AGPL-3.0", "BSD-2-Clause", "BSD-3-Clause", None, "Apache-2.0"
    ]
    assert not any(by[100 + i] for i in range(200))

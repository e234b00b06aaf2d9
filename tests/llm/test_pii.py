import hashlib
import itertools
import random
import re

import numpy as np

from courtline.llm import pii
from courtline.llm.common import table
from llm_util import collected, empty, odd_documents

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return pii.in_order(out)


def test_base_spans_are_the_patterns():
    rng = random.Random(0)
    for _ in range(20_000):
        text = "".join(rng.choice("aB@.-+ 0123459%()é\n") for _ in range(rng.randrange(60)))
        assert brute(text) == pii.base_spans(text), text
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.base_spans("4111-1111 1111 1111") == [("card", 0, 19)]
    assert pii.base_spans("9" * 50_000 + ".1.1") == []


def test_documents(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = collected(pii.detect(docs), "doc_id")
    assert len(rows) == len(texts)
    extra = clean = 0
    for r in rows:
        base = brute(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(pii.joined(base).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(x[0] == k for x in base) for k in pii.KINDS]
        spans = r["spans"].split(",") if r["spans"] else []
        assert set(pii.joined(base).split(",")) <= {*spans, ""}
        extra += len(spans) - len(base)
        clean += not base
    assert extra <= 0.01 * clean  # clean documents stay clean


def test_network_finds_held_out_and_rewritten_spans(spark):
    docs = table(spark, "/root/testdata/sf0.1", "documents").filter("n_chars < 6000").limit(6000)
    texts = [r["text"] for r in docs.select("text").collect()]
    labelled = [x for t in texts[:4000] for x in pii.examples(t, pii.base_spans(t), 80, 4)]
    w = pii.train(labelled)
    held = [t for t in texts[4000:] if pii.base_spans(t)][:150]
    tags = pii.tag(w, held)
    hit = [(g[a:b] == 1 + pii.ORDER[k]).mean() > 0.8 for t, g in zip(held, tags, strict=True) for k, a, b in pii.base_spans(t)]
    assert sum(hit) >= 0.9 * len(hit)
    # rewritten spans of held-out documents, of every kind, at offsets all over a window and its overlaps
    prose = next(t for t in texts[4000:] if not pii.base_spans(t) and 900 < len(t) < 3000)
    for kind in pii.KINDS:
        own = [t[a:b] for t in texts[4000:] for k, a, b in pii.base_spans(t) if k == kind][:8]
        for n in range(3):
            made = []
            for at in range(0, pii.WINDOW, 5):
                forms = pii.variants(kind, own[at % len(own)])
                off = prose.index(" ", 100 + at) + 1
                text = prose[:off] + forms[n % len(forms)] + " " + prose[off:]
                if not pii.base_spans(text):
                    made.append((text, off, off + len(forms[n % len(forms)])))
            found = pii.find(w, [m[0] for m in made])
            hit = [any(k == kind and min(b, d) - max(a, c) >= 0.8 * (b - a) for k, c, d in all_) for (_, a, b), (_, all_) in zip(made, found, strict=True)]
            assert sum(hit) >= 0.85 * len(hit), (kind, n, sum(hit), len(hit))
    changed = "Th enou thonan bosbt.42 at mail8.example.com thblewhor the or"
    assert pii.base_spans(changed) == []
    assert [k for k, *_ in pii.find(w, [changed])[0][1]] == ["email"]


def test_one_best_path_over_whole_texts():
    """Cut at sure places and decoded in pieces, it is the path of one decode; scores sum to one window's where none overlap."""
    import numpy as np

    rng = np.random.default_rng(5)
    move = rng.normal(0, 1, (pii.TAGS, pii.TAGS)).astype(np.float32)
    texts = []
    for n in (0, 1, 2, 3, 50, 400, 401, 2000):
        e = rng.normal(0, 2, (pii.TAGS, n)).astype(np.float32)
        e[0] += np.repeat(rng.choice([0, 4, 30], n // 5 + 1), 5)[:n]
        texts.append(e)
    got = pii.decode_texts(texts, move)
    for e, tags in zip(texts, got, strict=True):
        assert len(tags) == e.shape[1]
        if len(tags):
            assert np.array_equal(tags, pii.decode(np.ascontiguousarray(e.T)[:, :, None], move)[:, 0])
    assert pii.decode_texts([], move) == [] and pii.tag(pii.start_weights(1), []) == []


def test_scores_do_not_depend_on_the_batch():
    import numpy as np

    w = pii.start_weights(1)
    rng = random.Random(6)
    texts = ["".join(rng.choice("abc @.1") for _ in range(n)) for n in (10, 100, 224, 225, 256, 257, 480, 1500)]
    together = pii.scores(w, [pii.char_classes(t) for t in texts])
    for t, e in zip(texts, together, strict=True):
        assert np.allclose(e, pii.scores(w, [pii.char_classes(t)])[0], atol=1e-4)
    short = pii.emissions(w, pii.char_classes(texts[2])[:, None])[:, :, 0].T
    assert np.allclose(together[2], short, atol=1e-4)


def test_windows_cover_whole_texts():
    import numpy as np

    w = pii.start_weights(1)
    text = "".join(random.Random(2).choice("abc @.1") for _ in range(1500))
    whole = pii.decode(pii.emissions(w, pii.char_classes(text)[:, None]), w["move"])[:, 0]
    cut = pii.tag(w, [text, "", text[:100]])
    assert len(cut[0]) == 1500 and len(cut[1]) == 0 and len(cut[2]) == 100
    assert (cut[0] == whole).mean() > 0.97
    assert np.array_equal(pii.tag(w, [text])[0], cut[0])


def test_gradients():
    import numpy as np

    rng = np.random.default_rng(0)
    w = pii.start_weights(3)
    x = rng.integers(1, 130, (7, 3))
    x[5:, 1] = 0
    y = rng.integers(0, pii.TAGS, (7, 3))
    w["move"] = rng.normal(0, 0.3, w["move"].shape).astype(np.float32)

    def loss():
        return pii.crf_gradient(pii.emissions(w, x), w["move"], y, x > 0)[0]

    keep = {}
    _, ge, gm = pii.crf_gradient(pii.emissions(w, x, keep), w["move"], y, x > 0)
    grad = pii.back(w, x, keep, ge) | {"move": gm}
    for k in w:
        at = np.unravel_index(np.abs(grad[k]).argmax(), w[k].shape)
        old, eps = w[k][at], 3e-3
        w[k][at] = old + eps
        up = loss()
        w[k][at] = old - eps
        down = loss()
        w[k][at] = old
        assert abs((up - down) / (2 * eps) - grad[k][at]) < 0.03 * abs(grad[k][at]) + 1e-3, k


def test_odd_rows(spark):
    rows = collected(pii.detect(odd_documents(spark)), "doc_id")
    assert len(rows) == 13
    by = {r["doc_id"]: r for r in rows}
    assert by[3]["spans"] == by[4]["spans"] == "" and by[3]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert (by[11]["n_email"], by[11]["n_phone"]) == (1, 1)
    assert by[11]["spans"].startswith("email:5:22")
    assert pii.detect(empty(spark)).count() == 0


def test_redact(spark):
    docs = odd_documents(spark)
    rows = {r["doc_id"]: r for r in pii.redact(docs).collect()}
    assert rows[11]["text"] == "mail [EMAIL] or [PHONE] now" and rows[11]["n_chars"] == 27
    assert rows[3]["text"] is None and rows[1]["text"].startswith("the quick")
    assert pii.redact(docs).columns == docs.columns
    assert pii.masked("abcdef", [("ip", 0, 3), ("card", 2, 4)]) == "[IP]ef"


def test_scores_by_a_plain_recurrence(monkeypatch):
    """Each direction by itself, one window and one step at a time; the operator gathers once a step for both."""
    w = pii.start_weights(3)
    texts = ["mail a.b@example.com now", "x", "Ünï 10.0.0.1"]
    steps = max(map(len, texts))
    x = np.zeros((steps, len(texts)), np.uint8)
    for j, t in enumerate(texts):
        x[: len(t), j] = pii.char_classes(t)
    gathers = []
    take = np.take
    monkeypatch.setattr(pii.np, "take", lambda *a, **k: gathers.append(1) or take(*a, **k))
    got = pii.emissions(w, x)
    assert len(gathers) == steps
    for j, t in enumerate(texts):
        want = np.tile(w["bias"].astype(float), (len(t), 1))
        for d in "fb":
            h, c = np.zeros(pii.HIDDEN), np.zeros(pii.HIDDEN)
            for at in range(len(t)) if d == "f" else range(len(t) - 1, -1, -1):
                i, f, o, a = np.split(w["x" + d][:, x[at, j]] + w["h" + d] @ h, 4)
                c = c / (1 + np.exp(-f)) + np.tanh(a) / (1 + np.exp(-i))
                h = np.tanh(c) / (1 + np.exp(-o))
                want[at] += w["o" + d] @ h
        assert np.allclose(got[: len(t), :, j], want, atol=1e-4)


def test_best_paths_by_all_paths():
    rng = np.random.default_rng(8)
    for _ in range(40):
        e = rng.integers(-2, 3, (4, pii.TAGS, 2)).astype(np.float32)
        move = rng.integers(-2, 3, (pii.TAGS, pii.TAGS)).astype(np.float32)
        got = pii.decode(e, move)
        for j in range(2):
            value = lambda p: sum(e[t, k, j] for t, k in enumerate(p)) + sum(move[a, b] for a, b in itertools.pairwise(p))
            assert value(got[:, j]) == max(map(value, itertools.product(range(pii.TAGS), repeat=4)))


def test_places_that_lose_to_sure_neighbours_are_not_decoded(monkeypatch):
    """A weak lead is open until its neighbours are known: then the path is cut there, and still is the one best path."""
    rng = np.random.default_rng(9)
    move = (3 * np.eye(pii.TAGS) - 1.5 + rng.normal(0, 0.1, (pii.TAGS, pii.TAGS))).astype(np.float32)
    texts = []
    for n in (1, 2, 300, 2000):
        e = rng.normal(0, 0.3, (pii.TAGS, n)).astype(np.float32)
        e[0] += np.where(rng.random(n) < 0.3, 4, 9)  # less and more than transitions can change
        e[1 + n % 4, n // 2 : n // 2 + 20] += 8
        texts.append(e)
    whole = [pii.decode(np.ascontiguousarray(e.T)[:, :, None], move)[:, 0] for e in texts]
    places = []
    decode = pii.decode
    monkeypatch.setattr(pii, "decode", lambda x, *a: places.append(x.shape[0] * x.shape[2]) or decode(x, *a))
    got = pii.decode_texts(texts, move)
    assert all(np.array_equal(a, b) for a, b in zip(got, whole, strict=True)) and any(t.any() for t in got)
    assert sum(places) < 200


def test_scoring_takes_no_tanh_and_stands_large_weights(monkeypatch):
    w = {k: 300 * v if k[0] == "x" else v for k, v in pii.start_weights(4).items()}
    x = np.random.default_rng(1).integers(1, pii.CLASSES, (60, 5)).astype(np.uint8)
    x[50:, 2] = 0
    kept = pii.emissions(w, x, {})
    monkeypatch.setattr(pii.np, "tanh", None)
    with np.errstate(invalid="raise", divide="raise"):
        got = pii.emissions(w, x)
    assert np.isfinite(got).all()
    real = np.broadcast_to((x != 0)[:, None], got.shape)
    assert np.allclose(got[real], kept[real], atol=1e-3)
    small = pii.start_weights(4)
    monkeypatch.undo()
    assert np.allclose(pii.emissions(small, x)[real], pii.emissions(small, x, {})[real], atol=1e-5)

"""Personal data: fixed patterns, and a character-level bidirectional LSTM with CRF transitions.

The patterns give the base spans, which always stay. The network learns from
labelled spans, the base spans of a bounded sample of documents and re-written
forms of them ("name at host", numbers without their usual marks), and adds
spans that the patterns miss. It is trained and run in numpy: overlapping
windows of the whole text are scored in batches, their scores are stitched, and
one best path is decoded over the whole text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtline.llm import common

KINDS = ("email", "ip", "card", "phone")
ORDER = {k: i for i, k in enumerate(KINDS)}
Span = tuple[str, int, int]

# The patterns of the base spans. A match starts at the first
# character of its run: possessive repeats and look-behinds change no match,
# they keep long runs linear.
_HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NAME = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_DIGIT = re.compile("[0-9]")
_IP = re.compile(r"[0-9](?<![0-9]{2})[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NAME_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    twice = [d - 9 if d > 9 else d for d in (2 * int(x) for x in digits[-2::-2])]
    return (sum(map(int, digits[::-2])) + sum(twice)) % 10 == 0


def emails(text: str) -> list[Span]:
    """Matches of ``[A-Za-z0-9._%+-]+@host``, found from the @ so that runs without one cost nothing."""
    found: list[Span] = []
    end = 0
    for m in _HOST.finditer(text):
        start = m.start()
        while start > end and text[start - 1] in _NAME_CHARS:
            start -= 1
        if start < m.start():
            found.append(("email", start, m.end()))
            end = m.end()
    return found


def base_spans(text: str) -> list[Span]:
    """Pattern matches of the whole text, by start, then kind."""
    found = emails(text) if "@" in text else []
    if _DIGIT.search(text) is None:  # an e-mail address alone needs none
        return found
    for m in _IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split(".")):
            found.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if 14 <= m.end() - m.start() <= 37:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c in "0123456789" for c in m[0]) <= 15:
                found.append(("phone", m.start(), m.end()))
    return in_order(found)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], ORDER[s[0]], s[2]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


# --- the network -------------------------------------------------------------

HIDDEN = 8
TAGS = 1 + len(KINDS)  # 0: none
WINDOW, MARGIN = 256, 16
#: Character classes: 0 pads, ASCII by itself, then other letters and other marks.
LETTER, MARK = 129, 130
CLASSES = 131


def char_classes(text: str) -> np.ndarray:
    if text.isascii():
        return np.frombuffer(text.encode(), np.uint8) + np.uint8(1)
    a = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(a < 128, a + 1, np.where(a < 0x2000, LETTER, MARK)).astype(np.uint8)


def start_weights(seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    w = {}
    for d in "fb":
        w["x" + d] = rng.normal(0, 0.3, (4 * HIDDEN, CLASSES))
        w["x" + d][HIDDEN : 2 * HIDDEN] += 1  # forget gates start open
        w["h" + d] = rng.normal(0, 0.3, (4 * HIDDEN, HIDDEN))
        w["o" + d] = rng.normal(0, 0.3, (TAGS, HIDDEN))
    w["bias"], w["move"] = np.zeros(TAGS), np.zeros((TAGS, TAGS))
    return {k: v.astype(np.float32) for k, v in w.items()}


def emissions(w: dict[str, np.ndarray], x: np.ndarray, keep: dict | None = None) -> np.ndarray:
    """Tag scores [T, TAGS, B] of windows ``x`` [T, B]; ``keep`` gets what the gradient needs.

    Both directions are steps of one recurrence. The first axis of ``z`` is the
    gate (input, forget, output, candidate), then come direction, window and
    unit: a character's share of a gate is one run of memory, each step gathers
    those of both directions at once, and all row operations are contiguous.
    Learning takes a sigmoid as a tanh of half its argument. Scoring takes
    sigmoids only, by the cheaper exp, a tanh being a sigmoid of twice its
    argument; cells and outputs are held at half their size, and the factors lie
    in the weights. Padding (0, after the text) leaves the backward state empty,
    so a window's scores do not depend on those it runs with.
    """
    steps, n = x.shape
    whole = int((x != 0).all(1).sum())
    scale = np.array([0.5, 0.5, 0.5, 1] if keep is not None else [-1, -1, -1, -2], np.float32)[:, None, None]
    size = np.float32(1 if keep is not None else 2)  # of an output, as held
    wx = scale * np.concatenate([w["x" + d].reshape(4, HIDDEN, CLASSES).transpose(0, 2, 1) for d in "fb"], 1)
    wh = size * scale[:, None] * np.stack([w["h" + d].reshape(4, HIDDEN, HIDDEN).transpose(0, 2, 1) for d in "fb"], 1)
    wx, wh = np.ascontiguousarray(wx), np.ascontiguousarray(wh)
    wo = [np.ascontiguousarray(size * w["o" + d].T) for d in "fb"]
    h, c, s = (np.zeros((2, n, HIDDEN), np.float32) for _ in range(3))
    z, u = np.empty((4, 2, n, HIDDEN), np.float32), np.empty((4, 2, n, HIDDEN), np.float32)
    places, row = np.empty((2, n), np.intp), np.empty((n, TAGS), np.float32)  # a step's rows of wx, a direction's scores
    out = np.empty((steps, n, TAGS), np.float32)
    i, f, o, a = z
    gates, both = z[:3], z.reshape(4, 2 * n, HIDDEN)
    with np.errstate(over="ignore"):  # 1 / (1 + inf) is 0, as it should be
        for t in range(steps):
            before = (h.copy(), c.copy()) if keep is not None else None
            places[0] = x[t]
            np.add(x[steps - 1 - t], CLASSES, out=places[1], dtype=np.intp)
            np.take(wx, places.reshape(-1), axis=1, out=both, mode="clip")
            z += np.matmul(h, wh, out=u)
            if keep is not None:
                np.tanh(z, out=z)
                gates *= 0.5
                gates += 0.5
            else:
                sigmoid(z)
                a -= 0.5
            c *= f
            c += np.multiply(i, a, out=s)
            if steps - 1 - t >= whole:
                c[1] *= (x[steps - 1 - t] != 0)[:, None]
            if keep is not None:
                np.tanh(c, out=s)
            else:
                sigmoid(np.multiply(c, -4, out=s))
                s -= 0.5
            np.multiply(o, s, out=h)
            for d, at in enumerate((t, steps - 1 - t)):
                if 2 * t + d < steps:  # the first direction to come to ``at``
                    np.matmul(h[d], wo[d], out=out[at])
                else:
                    out[at] += np.matmul(h[d], wo[d], out=row)
                if keep is not None:
                    rows = (np.array(v[d].T, order="C") for v in (*before, c, s, h))
                    keep["fb"[d], at] = (z[:, d].transpose(0, 2, 1).reshape(4 * HIDDEN, n), *rows)
    out += w["bias"]
    return out.transpose(0, 2, 1)


def sigmoid(z: np.ndarray) -> None:
    """The sigmoid of minus ``z``, in its place."""
    np.exp(z, out=z)
    z += 1
    np.divide(np.float32(1), z, out=z)


def back(w: dict[str, np.ndarray], x: np.ndarray, keep: dict, g: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of the weights, given that of the tag scores ``g`` [T, TAGS, B]."""
    steps, n = x.shape
    grad = {k: np.zeros_like(v) for k, v in w.items()}
    grad["bias"] = g.sum((0, 2))
    for d in "fb":
        dh_next, dc_next = np.zeros((HIDDEN, n), np.float32), np.zeros((HIDDEN, n), np.float32)
        for t in range(steps - 1, -1, -1) if d == "f" else range(steps):
            z, h0, c0, c, s, h = keep[d, t]
            i, f, o, a = z[:HIDDEN], z[HIDDEN : 2 * HIDDEN], z[2 * HIDDEN : 3 * HIDDEN], z[3 * HIDDEN :]
            grad["o" + d] += g[t] @ h.T
            dh = w["o" + d].T @ g[t] + dh_next
            dc = dh * o * (1 - s * s) + dc_next
            if d == "b":
                dc *= x[t] != 0
            dz = np.concatenate([dc * a * i * (1 - i), dc * c0 * f * (1 - f), dh * s * o * (1 - o), dc * i * (1 - a * a)])
            dc_next = dc * f
            dh_next = w["h" + d].T @ dz
            grad["h" + d] += dz @ h0.T
            one = np.zeros((n, CLASSES), np.float32)
            one[np.arange(n), x[t]] = 1
            grad["x" + d] += dz @ one
    return grad


def crf_gradient(e: np.ndarray, move: np.ndarray, y: np.ndarray, real: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Loss and gradients of scores [T, TAGS, B] and transitions for tags ``y`` [T, B]; ``real`` masks padding."""
    steps, tags, n = e.shape
    e = np.where(real[:, None, :], e.astype(np.float64), np.where(np.arange(tags)[None, :, None] == 0, 0.0, -30.0))
    y = np.where(real, y, 0)

    def total(v, axis):
        m = v.max(axis, keepdims=True)
        return np.squeeze(m, axis) + np.log(np.exp(v - m).sum(axis))

    alpha, beta = np.empty_like(e), np.zeros_like(e)
    alpha[0] = e[0]
    for t in range(1, steps):
        alpha[t] = e[t] + total(alpha[t - 1][:, None, :] + move[:, :, None], 0)
    for t in range(steps - 2, -1, -1):
        beta[t] = total(move[:, :, None] + (e[t + 1] + beta[t + 1])[None], 1)
    z = total(alpha[-1], 0)
    ge = np.exp(alpha + beta - z)
    gm = np.zeros_like(move, dtype=np.float64)
    col = np.arange(n)
    for t in range(1, steps):
        p = np.exp(alpha[t - 1][:, None, :] + move[:, :, None] + (e[t] + beta[t])[None] - z)
        gm += p.sum(2)
        np.add.at(gm, (y[t - 1], y[t]), -1.0)
    gold = np.take_along_axis(e, y[:, None, :], 1)[:, 0].sum(0) + move[y[:-1], y[1:]].sum(0)
    for t in range(steps):
        ge[t, y[t], col] -= 1
    return float((z - gold).mean()), (ge * real[:, None, :] / n).astype(np.float32), (gm / n).astype(np.float32)


def decode(e: np.ndarray, move: np.ndarray, first: np.ndarray | None = None, last: np.ndarray | None = None) -> np.ndarray:
    """Best tags [T, B] for scores [T, TAGS, B]; ``first`` and ``last`` are scores of the ends' tags [TAGS, B]."""
    steps, tags, n = e.shape
    score = np.empty((steps, tags, n), np.result_type(e, move))
    score[0] = e[0] if first is None else e[0] + first
    for t in range(1, steps):
        (score[t - 1][:, None, :] + move[:, :, None]).max(0, out=score[t])
        score[t] += e[t]
    out = np.empty((steps, n), np.uint8)
    out[-1] = (score[-1] if last is None else score[-1] + last).argmax(0)
    for t in range(steps - 1, 0, -1):
        out[t - 1] = (score[t - 1] + move[:, out[t]]).argmax(0)  # only of the tag gone to
    return out


def gains(move: np.ndarray) -> np.ndarray:
    """The greatest gain [set, tag] over each set of neighbours, as bits, given that of each neighbour [neighbour, tag]."""
    sets = np.arange(2**TAGS)[:, None] >> np.arange(TAGS) & 1
    out = np.where(sets[:, :, None] == 1, move[None], -np.inf).max(1)
    out[0] = 0
    return out.astype(np.float32)


#: Stretches decoded at once have no more than so many places.
PLACES = 200_000


def decode_texts(scores_: list[np.ndarray], move: np.ndarray) -> list[np.ndarray]:
    """Best tags of whole texts by their scores [TAGS, length]: one path over all of each text.

    Where no tag is so far ahead that it wins whatever its neighbours are (its
    lead is more than changing to it can lose in transitions), the best path
    goes through it. Tags that lose whatever their neighbours are can't be those
    neighbours, so the rest is narrowed twice more by what is left. The path is
    cut at the sure places, exactly, and only the stretches between are decoded,
    those of all texts by their lengths. A stretch before such a place may be
    lengthened by places without a tag.
    """
    e = np.concatenate([x.T for x in scores_]) if scores_ else np.zeros((0, TAGS), np.float32)
    n = len(e)
    ends = np.cumsum([x.shape[1] for x in scores_], dtype=np.int64)
    tags = np.zeros(n, np.uint8)
    starts = np.zeros(n + 1, bool)
    starts[ends] = starts[0] = True  # of texts
    # the most that tag k, rather than no tag, can gain over two sets of neighbours; the empty set is a text's edge
    before_, after_ = gains(move - move[:, :1]).T, gains((move - move[:1]).T).T
    both = (before_[:, :, None] + after_[:, None]).reshape(TAGS, -1)
    most_ = np.maximum(before_[:, -1], 0) + np.maximum(after_[:, -1], 0)
    rows, open_ = np.ascontiguousarray(e.T), np.zeros(n, bool)
    for k in range(1, TAGS):
        open_ |= rows[k] + most_[k] >= rows[0]
    may = open_ * np.uint8(2**TAGS - 2) + np.uint8(1)  # the set of tags that a place may have, as bits
    at = np.flatnonzero(open_)
    for _ in range(2):
        left, right = may.take(at - 1, mode="wrap"), may.take(at + 1, mode="wrap")
        left[starts[at]], right[starts[at + 1]] = 0, 0
        sides = left * np.intp(2**TAGS) + right
        own, tags_ = rows[0].take(at, mode="clip"), np.ones(len(at), np.uint8)
        for k in range(1, TAGS):
            best = rows[k].take(at, mode="clip")
            best += both[k].take(sides, mode="clip")
            tags_ += (best >= own) * np.uint8(1 << k)
        may[at] &= tags_
        at = at[may[at] > 1]
    open_ = may > 1
    a = np.flatnonzero(open_ & (starts[:-1] | ~np.r_[False, open_[:-1]]))
    b = 1 + np.flatnonzero(open_ & (starts[1:] | ~np.r_[open_[1:], False]))
    cut = starts[b]  # ends with its text
    order = np.lexsort((b - a, cut))
    lengths, before = (b - a)[order], int((~cut).sum())
    no_tag = np.full(TAGS, -1e9, np.float32)
    no_tag[0] = 0
    at = 0
    while at < len(order):
        alike = before if at < before else len(order)
        most = lengths[at] + lengths[at] // 8 + 2 if at < before else lengths[at]
        to = at + int(np.searchsorted(lengths[at:alike], most, side="right"))
        to = min(to, at + max(1, PLACES // int(most)))
        part = order[at:to]
        size = (b[part] - a[part]).max()
        place = a[part] + np.arange(size)[:, None]
        inside = place < b[part]
        x = np.where(inside[:, None], e.take(np.minimum(place, n - 1), axis=0).transpose(0, 2, 1), no_tag[:, None])
        first = np.where(starts[a[part]], 0, move[0][:, None])
        best = decode(x, move, first.astype(np.float32), None if cut[part[0]] else np.repeat(move[:, :1], len(part), 1))
        tags[place[inside]] = best[inside]
        at = to
    return np.split(tags, ends[:-1]) if scores_ else []


def train(windows: list[tuple[str, list[Span]]], steps: int = 400, batch: int = 48, length: int = 80, seed: int = 0) -> dict[str, np.ndarray] | None:
    """Weights from labelled windows, by Adam; None without any labelled span."""
    if not any(spans for _, spans in windows):
        return None
    rng = np.random.default_rng(seed)
    marked = [i for i, (_, s) in enumerate(windows) if s]
    plain = [i for i, (_, s) in enumerate(windows) if not s] or marked
    x, y = np.zeros((len(windows), length), np.uint8), np.zeros((len(windows), length), np.uint8)
    for i, (text, spans) in enumerate(windows):
        cls = char_classes(text)[:length]
        x[i, : len(cls)] = cls
        for k, a, b in spans:
            y[i, a : min(b, length)] = 1 + ORDER[k]
    w = start_weights(seed)
    m = {k: np.zeros_like(v) for k, v in w.items()}
    v = {k: np.zeros_like(p) for k, p in w.items()}
    for step in range(1, steps + 1):
        rows = np.concatenate([rng.choice(marked, batch // 2), rng.choice(plain, batch - batch // 2)])
        keep: dict = {}
        xs, ys = np.ascontiguousarray(x[rows].T), y[rows].T.astype(np.int64)
        e = np.ascontiguousarray(emissions(w, xs, keep))
        _, ge, gm = crf_gradient(e, w["move"], ys, xs > 0)
        grad = back(w, xs, keep, ge)
        grad["move"] = gm
        size = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
        rate = 0.03 * min(1.0, 2 - 2 * step / steps)
        for k, g in grad.items():
            g = g * min(1.0, 5 / (size + 1e-9))
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            w[k] = (w[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return w


#: How much the places of an overlap count, from a window's edge inwards; the other window has the rest.
_RAMP = np.arange(1, 2 * MARGIN + 1, dtype=np.float32) / (2 * MARGIN + 1)


def scores(w: dict[str, np.ndarray], classes: list[np.ndarray], batch: int = 1024) -> list[np.ndarray]:
    """Scores [TAGS, length] of whole texts, stitched from overlapping windows.

    Windows are ``WINDOW`` long and overlap by twice ``MARGIN``. Where two
    overlap, their scores are averaged, each counting the more the farther the
    place is from that window's edge. Windows of like length run together.
    """
    starts = np.cumsum([0, *map(len, classes)])
    total = np.zeros((starts[-1], TAGS), np.float32)  # of all texts, a place's scores side by side
    step = WINDOW - 2 * MARGIN
    jobs = [(min(len(c), a + WINDOW) - a, i, a) for i, c in enumerate(classes) for a in range(0, max(1, len(c) - 2 * MARGIN), step) if len(c)]
    jobs.sort()
    for at in range(0, len(jobs), batch):
        part = jobs[at : at + batch]
        x = np.zeros((len(part), part[-1][0]), np.uint8)
        for row, (n, i, a) in zip(x, part, strict=True):
            row[:n] = classes[i][a : a + n]
        e = emissions(w, np.ascontiguousarray(x.T)).transpose(0, 2, 1)
        follows = np.array([a > 0 for _, _, a in part])
        followed = np.array([a + n < len(classes[i]) for n, i, a in part])  # such windows are whole
        if follows.any():
            e[: 2 * MARGIN] *= np.where(follows, _RAMP[: len(e), None], np.float32(1))[:, :, None]
        if followed.any():
            e[WINDOW - 2 * MARGIN :] *= np.where(followed, _RAMP[::-1, None], np.float32(1))[:, :, None]
        e = np.ascontiguousarray(e.transpose(1, 0, 2))
        for one, (n, i, a) in zip(e, part, strict=True):
            total[starts[i] + a : starts[i] + a + n] += one[:n]
    return [t.T for t in np.split(total, starts[1:-1])] if classes else []


def tag(w: dict[str, np.ndarray], texts: list[str], batch: int = 1024) -> list[np.ndarray]:
    """The tag of every character of every text: the windows' stitched scores, decoded once over each whole text."""
    classes = [char_classes(t) for t in texts]
    return decode_texts(scores(w, classes, batch), w["move"])


def runs(tags: np.ndarray, text: str) -> list[Span]:
    """Runs of one tag, across windows, without white space at their ends; runs of under six characters or without a digit, @ or "at" are dropped."""
    if not tags.any():
        return []
    edge = np.flatnonzero(np.diff(tags, prepend=0, append=0))
    found = []
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        if tags[a]:
            while a < b and text[a].isspace():
                a += 1
            while b > a and text[b - 1].isspace():
                b -= 1
            kind = KINDS[tags[a] - 1] if a < b and tags[a] else None
            if kind and b - a >= 6 and plausible(kind, text[a:b]):
                found.append((kind, a, b))
    return found


def plausible(kind: str, part: str) -> bool:
    """What a learned span must hold to be added: an address sign and a dot sign, or the kind's number of digits."""
    digits = sum(c in "0123456789" for c in part)
    if kind == "email":
        return bool(re.search(r"@| at |\(at\)|\[at\]", part)) and bool(re.search(r"\.| dot |\(dot\)|\[dot\]", part))
    return {"ip": 4 <= digits <= 12, "card": 14 <= digits <= 19, "phone": 10 <= digits <= 15}[kind]


def all_spans(base: list[Span], learned: list[Span]) -> list[Span]:
    """Base spans, and the learned spans that overlap none of them."""
    taken = sorted((a, b) for _, a, b in base)
    starts = np.array([a for a, _ in taken])
    ends = np.maximum.accumulate([b for _, b in taken]) if taken else np.array([])
    free = []
    for k, a, b in learned:
        before = int(np.searchsorted(starts, b))
        if not before or ends[before - 1] <= a:
            free.append((k, a, b))
    return in_order([*base, *free])


# --- learning from a bounded sample ------------------------------------------


def variants(kind: str, part: str) -> list[str]:
    """Other ways to write a span, that the patterns don't match."""
    if kind == "email":
        return [part.replace("@", " at "), part.replace("@", "(at)"), part.replace("@", " at ").replace(".", " dot ")]
    if kind == "phone":
        return [part.lstrip("+"), "00" + part[1:], part[1:].replace(" ", ".")]
    if kind == "card":
        digits = re.sub("[^0-9]", "", part)
        groups = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        return [".".join(groups), "/".join(groups), " - ".join(groups)]
    return [part.replace(".", " . "), part.replace(".", "[.]")]


def examples(text: str, spans: list[Span], length: int, most: int) -> list[tuple[str, list[Span]]]:
    """Labelled windows around at most ``most`` spans of a text, as they are and re-written, and windows without any."""
    out = []
    for n, (k, a, b) in enumerate(spans[:most]):
        before = (7 * n + a) % max(1, length - (b - a)) // 2
        lo = max(0, a - before)
        if b - lo > length:
            continue
        out.append((text[lo : lo + length], [(q, max(0, c - lo), d - lo) for q, c, d in spans if c < lo + length and d > lo]))
        for other in variants(k, text[a:b]):
            if a - lo + len(other) <= length:
                out.append((text[lo:a] + other + text[b : b + length], [(k, a - lo, a - lo + len(other))]))
    for at in range(0, min(len(text), length * most), length):
        if not any(c < at + length and d > at for _, c, d in spans):
            out.append((text[at : at + length], []))
    return [(t[:length], [(k, a, min(b, length)) for k, a, b in s if a < length]) for t, s in out]


_EXAMPLE = "doc_id long, text string, spans array<struct<kind: string, start: int, end: int>>"


def _examples(length: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.pieces(batches):
            rows = [(r["doc_id"], *x) for r in b.to_pylist() if r["text"] for x in examples(r["text"], base_spans(r["text"]), length, most)]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": [r[0] for r in rows],
                    "text": [r[1] for r in rows],
                    "spans": [[{"kind": k, "start": s, "end": e} for k, s, e in r[2]] for r in rows],
                },
                schema=pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("spans", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])))]),
            )

    return run


def fit(docs: DataFrame, sample: int = 4000, per_doc: int = 4, length: int = 80) -> dict[str, np.ndarray] | None:
    """Train on labelled windows of ``sample`` documents (lowest key hashes), at most ``per_doc`` spans of each."""
    common.short_batches(docs.sparkSession)
    ids = common.sample_ids(docs.filter("text IS NOT NULL AND doc_id IS NOT NULL"), sample)  # bounded by ``sample``
    rows = (
        docs.join(F.broadcast(ids), "doc_id", "left_semi")
        .select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .mapInArrow(_examples(length, per_doc), _EXAMPLE)
        .dropDuplicates(["doc_id", "text"])
        .collect()
    )
    rows.sort(key=lambda r: (r["doc_id"], r["text"]))
    return train([(r["text"], [(s["kind"], s["start"], s["end"]) for s in r["spans"]]) for r in rows], length=length)


def find(w: dict[str, np.ndarray] | None, texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and all spans of each text."""
    tags = tag(w, texts) if w is not None else [None] * len(texts)
    out = []
    for text, t in zip(texts, tags, strict=True):
        base = base_spans(text)
        out.append((base, base if t is None else all_spans(base, runs(t, text))))
    return out


def scanner(spark: SparkSession, w: dict[str, np.ndarray] | None):
    """A function of a text column giving the base spans and all spans, ``kind:start:end`` joined by commas."""
    sent = spark.sparkContext.broadcast(w)

    @F.arrow_udf("struct<n: array<long>, base: string, spans: string>")
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            n, base, spans = [], [], []
            for at in range(0, len(texts), common.ARROW_ROWS):
                for b, s in find(sent.value, [t or "" for t in texts[at : at + common.ARROW_ROWS].to_pylist()]):
                    n.append([sum(k == x[0] for x in b) for k in KINDS])
                    base.append(joined(b))
                    spans.append(joined(s))
            arrays = [pa.array(n, pa.list_(pa.int64())), pa.array(base, pa.string()), pa.array(spans, pa.string())]
            yield pa.StructArray.from_arrays(arrays, ["n", "base", "spans"])

    return scan


def detect(docs: DataFrame, weights: dict[str, np.ndarray] | None = None) -> DataFrame:
    """doc_id, base-span counts, base_sha256 and spans of every row.

    Null text is empty and has no spans. Whole texts are scanned, however
    long. Repeated rows give equal rows; an empty table none, and learning
    from a table without personal data leaves the base spans alone. Only
    doc_id and text are read; other columns may have any name. Counts and
    checksum are those of the base spans; ``spans`` has the learned ones too.
    """
    common.short_batches(docs.sparkSession)
    scan = scanner(docs.sparkSession, weights if weights is not None else fit(docs))
    rows = docs.select("doc_id", scan("text").alias("_s"))
    return rows.select(
        "doc_id", *[F.col("_s.n")[i].alias(f"n_{k}") for i, k in enumerate(KINDS)], F.sha2(F.col("_s.base"), 256).alias("base_sha256"), "_s.spans"
    )


def masked(text: str, spans: list[Span]) -> str:
    """``text`` with each span replaced by its kind in brackets; overlapping spans become one, of the first's kind."""
    out, at = [], 0
    for k, a, b in spans:
        if a >= at:
            out += [text[at:a], f"[{k.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, weights: dict[str, np.ndarray] | None = None) -> DataFrame:
    """``docs`` with all found spans of ``text`` masked and ``n_chars``, where there is one, counted anew; null stays null."""
    common.short_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(weights if weights is not None else fit(docs))

    @F.arrow_udf("string")
    def clean(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            out = []
            for at in range(0, len(texts), common.ARROW_ROWS):
                whole = texts[at : at + common.ARROW_ROWS].to_pylist()
                found = find(sent.value, [t or "" for t in whole])
                out += [None if t is None else masked(t, spans) for t, (_, spans) in zip(whole, found, strict=True)]
            yield pa.array(out, pa.string())

    out = docs.withColumn("text", clean(docs["text"]))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out

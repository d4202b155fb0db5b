"""Personal data by fixed patterns plus a character BiLSTM-CRF.

*Base spans* are the matches of four fixed patterns with their checks (parts of
an ip, Luhn digits of a card, digits of a phone number).

*The tagger* reads characters as classes (lower, upper, digit, each of some
marks), runs one LSTM in each direction and decodes B/I tags per kind with CRF
transitions.  It is trained in numpy on windows of a bounded sample of
documents, labelled by the base spans.  A span of any kind holds a digit or an
``@``, so only text near one is read: regions around those characters are cut
into overlapping windows, every window is decoded alone, and each character
takes its tag from the window whose middle is nearest, over the whole text.

Spans the tagger adds must not touch a base span, must be tagged with
confidence, and must pass a loose form of their kind's check; base spans always
stay.
"""

from __future__ import annotations

import bisect
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import spread_scan

KINDS = ("email", "ip", "card", "phone")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
ANCHOR = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def email_spans(text: str) -> list[tuple[int, int]]:
    """Leftmost matches; found from each ``@`` backwards, so that a long run
    without one costs nothing."""
    out, free = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL_CHARS:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return out


def ip_spans(text: str) -> list[tuple[int, int]]:
    """Numbers joined by dots, four at a time from the left."""
    out = []
    for m in DOTTED.finditer(text):
        parts = m.group().split(".")
        at = m.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k:k + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in four):
                out.append((at, end))
            at = end + 1
    return out


def card_spans(text: str) -> list[tuple[int, int]]:
    out = []
    for m in CARD.finditer(text):
        d = digits_of(m.group()) if m.end() - m.start() <= 40 else ""
        if 13 <= len(d) <= 19 and luhn(d):
            out.append(m.span())
    return out


def phone_spans(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in PHONE.finditer(text) if 9 <= len(digits_of(m.group())) <= 15]


def base_spans(text: str | None) -> dict[str, list[tuple[int, int]]]:
    if not text or not ANCHOR.search(text):
        return {k: [] for k in KINDS}
    return {"email": email_spans(text), "ip": ip_spans(text), "card": card_spans(text), "phone": phone_spans(text)}


def loose(kind: str, s: str) -> bool:
    """What a span added by the tagger must look like."""
    d = digits_of(s)
    if kind == "email":
        name, _, host = s.partition("@")
        return bool(name.strip()) and "." in host.strip(".") and " " not in s
    if kind == "ip":
        parts = re.findall(r"[0-9]+", s)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == "card":
        return 13 <= len(d) <= 19 and luhn(d)
    return 9 <= len(d) <= 15


# -- the tagger -----------------------------------------------------------------

MARKS = " \n@.-_+()%:/,;"
PAD, LOWER, UPPER, DIGIT, HIGH, OTHER = range(6)
CLASSES = 6 + len(MARKS)
TAGS = 1 + 2 * len(KINDS)  # O, then B and I of each kind
WINDOW, STRIDE, MARGIN = 64, 32, 20


def _ascii_classes() -> np.ndarray:
    table = np.full(128, OTHER, np.int8)
    table[ord("a"):ord("z") + 1] = LOWER
    table[ord("A"):ord("Z") + 1] = UPPER
    table[ord("0"):ord("9") + 1] = DIGIT
    for i, c in enumerate(MARKS):
        table[ord(c)] = 6 + i
    return table


ASCII = _ascii_classes()


def char_classes(text: str) -> np.ndarray:
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(code < 128, ASCII[np.minimum(code, 127)], HIGH).astype(np.int8)


def windows_near(text: str) -> list[int]:
    """Starts of the windows over the regions near a digit or ``@``."""
    starts: list[int] = []
    region = None
    for m in ANCHOR.finditer(text):
        a, z = max(0, m.start() - MARGIN), min(len(text), m.end() + MARGIN)
        if region and a <= region[1]:
            region[1] = z
        else:
            if region:
                starts += range(region[0], max(region[0] + 1, region[1] - STRIDE), STRIDE)
            region = [a, z]
    if region:
        starts += range(region[0], max(region[0] + 1, region[1] - STRIDE), STRIDE)
    return starts


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Tagger:
    """BiLSTM emissions with CRF transitions; parameters in one dict."""

    def __init__(self, hidden: int = 16, seed: int = 7):
        rnd = np.random.default_rng(seed)
        h = hidden
        self.hidden = h
        self.p = {}
        for d in ("f", "b"):
            self.p[f"x{d}"] = rnd.normal(0, 0.3, (CLASSES, 4 * h))
            self.p[f"h{d}"] = rnd.normal(0, 1 / h**0.5, (h, 4 * h))
            bias = np.zeros(4 * h)
            bias[h:2 * h] = 1.0  # forget gate
            self.p[f"c{d}"] = bias
        self.p["out"] = rnd.normal(0, 0.3, (2 * h, TAGS))
        self.p["out0"] = np.zeros(TAGS)
        self.p["trans"] = np.zeros((TAGS, TAGS))

    def as_type(self, kind):
        self.p = {k: v.astype(kind) for k, v in self.p.items()}
        return self

    def _direction(self, x: np.ndarray, d: str, keep: list | None):
        n, length = x.shape
        hs = self.hidden
        wx, wh, b = self.p["x" + d], self.p["h" + d], self.p["c" + d]
        h = np.zeros((n, hs), wx.dtype)
        c = np.zeros((n, hs), wx.dtype)
        out = np.empty((n, length, hs), wx.dtype)
        for t in (range(length) if d == "f" else range(length - 1, -1, -1)):
            z = wx[x[:, t]] + h @ wh + b
            g = np.tanh(z[:, 3 * hs:])
            s = sigmoid(z[:, :3 * hs])
            i, f, o = s[:, :hs], s[:, hs:2 * hs], s[:, 2 * hs:]
            before, prev = c, h
            c = f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            out[:, t] = h
            if keep is not None:
                keep.append((t, i, f, o, g, before, prev, tc))
        return out

    def emissions(self, x: np.ndarray, keep: dict | None = None) -> np.ndarray:
        both = [self._direction(x, d, None if keep is None else keep.setdefault(d, [])) for d in ("f", "b")]
        hid = np.concatenate(both, axis=2)
        if keep is not None:
            keep["hid"] = hid
        return hid @ self.p["out"] + self.p["out0"]

    def viterbi(self, e: np.ndarray) -> np.ndarray:
        n, length, _ = e.shape
        score = e[:, 0]
        back = np.empty((n, length, TAGS), np.int8)
        for t in range(1, length):
            step = score[:, :, None] + self.p["trans"]
            back[:, t] = step.argmax(1)
            score = step.max(1) + e[:, t]
        tags = np.empty((n, length), np.int8)
        tags[:, -1] = score.argmax(1)
        for t in range(length - 1, 0, -1):
            tags[:, t - 1] = back[np.arange(n), t, tags[:, t]]
        return tags

    def loss_gradient(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood per window and its gradient."""
        n, length = x.shape
        keep: dict = {}
        e = self.emissions(x, keep)
        trans = self.p["trans"]

        def lse(a, axis):
            m = a.max(axis, keepdims=True)
            return (m + np.log(np.exp(a - m).sum(axis, keepdims=True))).squeeze(axis)

        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[:, 0] = e[:, 0]
        for t in range(1, length):
            alpha[:, t] = lse(alpha[:, t - 1, :, None] + trans, 1) + e[:, t]
        for t in range(length - 2, -1, -1):
            beta[:, t] = lse(trans + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
        z = lse(alpha[:, -1], 1)
        rows = np.arange(n)[:, None]
        gold = e[rows, np.arange(length), y].sum(1) + trans[y[:, :-1], y[:, 1:]].sum(1)
        de = np.exp(alpha + beta - z[:, None, None])
        de[rows, np.arange(length), y] -= 1
        pair = np.exp(alpha[:, :-1, :, None] + trans + (e[:, 1:] + beta[:, 1:])[:, :, None, :] - z[:, None, None, None])
        dtrans = pair.sum((0, 1))
        np.add.at(dtrans, (y[:, :-1].ravel(), y[:, 1:].ravel()), -1)
        grad = {"trans": dtrans / n}
        de /= n
        grad["out"] = np.einsum("nth,ntk->hk", keep["hid"], de)
        grad["out0"] = de.sum((0, 1))
        dhid = de @ self.p["out"].T
        hs = self.hidden
        for d, part in (("f", dhid[:, :, :hs]), ("b", dhid[:, :, hs:])):
            wh = self.p["h" + d]
            gx, gh, gb = np.zeros_like(self.p["x" + d]), np.zeros_like(wh), np.zeros_like(self.p["c" + d])
            dh, dc = np.zeros((n, hs)), np.zeros((n, hs))
            for t, i, f, o, g, before, prev, tc in reversed(keep[d]):
                dh = dh + part[:, t]
                dc = dc + dh * o * (1 - tc * tc)
                dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o),
                                     dc * i * (1 - g * g)], axis=1)
                np.add.at(gx, x[:, t], dz)
                gh += prev.T @ dz
                gb += dz.sum(0)
                dh, dc = dz @ wh.T, dc * f
            grad["x" + d], grad["h" + d], grad["c" + d] = gx, gh, gb
        return float((z - gold).mean()), grad

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = 300, batch: int = 64, rate: float = 0.02, seed: int = 1):
        """Adam over ``steps`` batches drawn from shuffled passes."""
        rnd = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(w) for k, w in self.p.items()}
        queue = np.empty(0, np.int64)
        for step in range(1, steps + 1):
            if not len(queue):
                queue = rnd.permutation(len(x))
            pick, queue = queue[:batch], queue[batch:]
            _, grad = self.loss_gradient(x[pick], y[pick])
            norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
            for k, g in grad.items():
                g = g * min(1.0, 5.0 / (norm + 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                self.p[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
        return self


def window_matrix(classes: np.ndarray, starts: list[int]) -> np.ndarray:
    padded = np.concatenate([classes, np.full(WINDOW, PAD, np.int8)])
    return padded[np.array(starts, np.int64)[:, None] + np.arange(WINDOW)]


def gold_tags(n: int, spans: dict[str, list[tuple[int, int]]]) -> np.ndarray:
    tags = np.zeros(n, np.int8)
    for k, kind in reversed(list(enumerate(KINDS))):
        for a, z in spans[kind]:
            tags[a] = 1 + 2 * k
            tags[a + 1:z] = 2 + 2 * k
    return tags


def training_windows(text: str, most: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """(characters, tags, keys) of at most ``most`` windows of the whole text: those
    with the smallest hash of text and position, which is their key."""
    starts = windows_near(text)
    seed = xxhash.xxh64_intdigest(text)
    chosen = sorted((xxhash.xxh64_intdigest(start.to_bytes(8, "little"), seed) >> 1, start) for start in starts)[:most]
    if not chosen:
        return np.empty((0, WINDOW), np.int64), np.empty((0, WINDOW), np.int64), []
    at = [start for _, start in chosen]
    return (window_matrix(char_classes(text), at).astype(np.int64),
            window_matrix(gold_tags(len(text), base_spans(text)), at).astype(np.int64),  # PAD is tag O
            [key for key, _ in chosen])


def train_tagger(docs: DataFrame, limit: int = 600, most_windows: int = 1_500, windows_per_text: int = 8) -> Tagger | None:
    """Train on at most ``most_windows`` windows, at most ``windows_per_text`` of
    each of at most ``limit`` documents that hold a digit or an ``@``; documents
    and windows (from anywhere in a text) are chosen by hashes.  None when there
    are none.  The sample's windows, not its texts, reach the driver."""
    def cut(batches):
        for b in batches:
            for i in range(b.num_rows):
                x, y, keys = training_windows(b.column(0)[i].as_py(), windows_per_text)
                if len(x):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r.astype(np.int8).tobytes() for r in x]), pa.array([r.astype(np.int8).tobytes() for r in y]),
                         pa.array(keys, pa.int64())], ["x", "y", "key"])

    hashed = docs.select("text", F.xxhash64("text").alias("h")).filter(F.col("text").rlike("[0-9@]"))
    # hashes alone are sorted; the ``limit`` chosen ones are a bounded broadcast
    chosen = hashed.select("h").distinct().orderBy("h").limit(limit)
    sample = hashed.join(F.broadcast(chosen), "h", "left_semi").groupBy("h").agg(F.first("text").alias("text")).select("text")
    got = sample.mapInArrow(cut, "x binary, y binary, key long").orderBy("key", "x", "y").limit(most_windows).collect()
    if not got:
        return None
    x, y = (np.array([np.frombuffer(r[k], np.int8) for r in got]).astype(np.int64) for k in ("x", "y"))
    return Tagger().fit(x, y).as_type(np.float32)


def tag_texts(model: Tagger, texts: list[str], together: int = 1024) -> list[list[tuple[str, int, int, float]]]:
    """(kind, start, end, confidence) found by the tagger in each text."""
    rows, owner, begin = [], [], []
    for i, t in enumerate(texts):
        starts = windows_near(t)
        if starts:
            rows.append(window_matrix(char_classes(t), starts))
            owner += [i] * len(starts)
            begin += starts
    out: list[list] = [[] for _ in texts]
    if not rows:
        return out
    x, same = np.unique(np.concatenate(rows), axis=0, return_inverse=True)
    tags, sure = np.empty(x.shape, np.int8), np.empty(x.shape, np.float32)
    for s in range(0, len(x), together):
        e = model.emissions(x[s:s + together])
        tags[s:s + together] = t = model.viterbi(e)
        e = np.exp(e - e.max(2, keepdims=True))
        sure[s:s + together] = np.take_along_axis(e, t[:, :, None].astype(np.int64), 2)[:, :, 0] / e.sum(2)
    owner_a, begin_a, same = np.array(owner), np.array(begin), same.ravel()
    hot = (tags != 0).any(1)
    # a window without tags still overrules its neighbours' edges
    for i in np.unique(owner_a[hot[same]]):
        mine = np.flatnonzero(owner_a == i)
        n = len(texts[i])
        where = begin_a[mine][:, None] + np.arange(WINDOW)
        from_middle = np.abs(np.arange(WINDOW) - (WINDOW - 1) / 2)[None, :].repeat(len(mine), 0)
        # a window at the edge of its region speaks for that edge
        ok = where < n
        flat, dist = where[ok], from_middle[ok]
        tag, conf = tags[same[mine]][ok], sure[same[mine]][ok]
        order = np.lexsort((dist, flat))
        flat, tag, conf = flat[order], tag[order], conf[order]
        first = np.flatnonzero(np.diff(flat, prepend=-1))
        flat, tag, conf = flat[first], tag[first], conf[first]
        k = 0
        while k < len(flat):
            if tag[k] == 0:
                k += 1
                continue
            kind, z = (tag[k] - 1) // 2, k + 1
            while z < len(flat) and flat[z] == flat[z - 1] + 1 and tag[z] == 2 + 2 * kind:
                z += 1
            out[i].append((KINDS[kind], int(flat[k]), int(flat[z - 1]) + 1, float(conf[k:z].min())))
            k = z
    return out


def added_spans(text: str, base: dict, found: list, least: float) -> dict[str, list[tuple[int, int]]]:
    taken = sorted(s for spans in base.values() for s in spans)
    ends = [z for _, z in taken]
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    for kind, a, z, sure in found:
        # base spans of one kind do not overlap, of two kinds they may: look at all that could reach
        clash = any(s < z and a < e for s, e in taken[max(0, bisect.bisect_right(ends, a) - 8):]) if taken else False
        if not clash and sure >= least and loose(kind, text[a:z]):
            out[kind].append((a, z))
    return out


def joined(spans: dict[str, list[tuple[int, int]]]) -> str:
    return ",".join(f"{k}:{a}:{z}" for k in KINDS for a, z in sorted(spans[k]))


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (),
                       limit: int = 600, least: float = 0.9, redact: bool = False) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base, spans, *carry), one row
    per row: counts and joined base spans, and all spans with the tagger's.

    Offsets are code points, ends exclusive.  A null text is empty and has no
    spans.  Without any digit or ``@`` in the sample there is no tagger and only
    base spans are returned.  Repeated rows are read as rows; an empty table
    gives an empty table.  ``redact`` adds ``redacted``: the text with every
    span replaced by its kind's name in angle brackets (null stays null)."""
    model = train_tagger(docs.select(F.col(text_col).alias("text")), limit)
    slim = spread_scan(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *carry))
    extra = [slim.schema[c] for c in carry]
    schema = (f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, n_email long, n_ip long, n_card long, "
              "n_phone long, base string, spans string" + ", redacted string" * redact
              + "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in extra))

    def run(batches):
        for b in batches:
            for s in range(0, b.num_rows, 256):
                part = b.slice(s, 256)
                raw = part.column(1).to_pylist()
                texts = [t or "" for t in raw]
                base = [base_spans(t) for t in texts]
                found = tag_texts(model, texts) if model else [[]] * len(texts)
                every = []
                for t, own, new in zip(texts, base, found):
                    plus = added_spans(t, own, new, least)
                    every.append({k: own[k] + plus[k] for k in KINDS})
                cols = [part.column(0), *(pa.array([len(x[k]) for x in base], pa.int64()) for k in KINDS),
                        pa.array([joined(x) for x in base], pa.string()), pa.array([joined(x) for x in every], pa.string())]
                if redact:
                    cols.append(pa.array([None if r is None else redacted(t, x) for r, t, x in zip(raw, texts, every)],
                                         pa.string()))
                cols += part.columns[2:]
                names = ["doc_id", *(f"n_{k}" for k in KINDS), "base", "spans", *["redacted"] * redact, *carry]
                yield pa.RecordBatch.from_arrays(cols, names)

    return slim.mapInArrow(run, schema)


def redacted(text: str, spans: dict[str, list[tuple[int, int]]]) -> str:
    """Overlapping spans become one, named after the first."""
    out, at = [], 0
    merged: list[list] = []
    for a, z, kind in sorted((a, z, k) for k in KINDS for a, z in spans[k]):
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(z, merged[-1][1])
        else:
            merged.append([a, z, kind])
    for a, z, kind in merged:
        out += [text[at:a], f"<{kind.upper()}>"]
        at = z
    return "".join(out) + text[at:]

"""Personal data: fixed patterns, and a character BiLSTM-CRF that adds spans.

The base spans come from four patterns (`base_spans`).  The model reads
characters in overlapping windows; a bidirectional LSTM gives each character a
score per tag (outside, or begin / inside of a kind), a CRF layer with learned
transitions decodes each window, and `reconcile` settles the windows' spans for
the whole document: pieces of one span that windows cut are joined, base spans
stand, and of what still overlaps the set of largest total confidence is taken
(weighted interval scheduling).  It is trained in numpy on labelled spans: by
default the base spans of a bounded sample of documents, some of them rewritten
into forms that the patterns miss (no plus sign, other separators), and the
text around them as negatives.

A span must hold a digit or `@`.  So windows without either cannot have one and
are not run; the results are those of running every window.

Scale.  One pass over whole texts without a shuffle; a worker holds a batch and
runs its windows in groups of `group`.  The model is a few kilobytes.  The
sample is at most `train_docs` documents, those of smallest id hash that hold a
digit or `@`, and a bounded number of windows of each.

Defined results: a null text counts as empty (no spans); a text of any length,
also one unbroken run of digits, is read whole; null and repeated ids are handled
like any other row; with nothing to learn from there are base spans only; an
empty table gives no rows; columns other than the id, the text and `keep` are
not read, and a kept one may have any name but those of `schema`.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices_of_rows

KINDS = ("email", "ip", "card", "phone")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")  # a start inside a run of digits fares as the run's first digit
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_SIGNAL = re.compile("[0-9@]")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = ord(d) - 48
        if k & 1:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by the fixed patterns, leftmost and not overlapping within a kind."""
    out = []
    at, past = text.find("@"), 0
    while at >= 0:
        start = at
        while start > past and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            out.append((0, start, past := m.end()))
        at = text.find("@", max(at + 1, past))
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p) <= 3 and int(p or "0") <= 255 for p in (p.lstrip("0") for p in m.group().split("."))):
                out.append((1, m.start(), m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 13:
                digits = m.group().replace(" ", "").replace("-", "")
                if 13 <= len(digits) <= 19 and luhn(digits):
                    out.append((2, m.start(), m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                    out.append((3, m.start(), m.end()))
    return out


# Characters: 0 pads, 1.. are ASCII 32..126, then white space, other letters, anything else.
_N_CHARS = 1 + 95 + 3
_N_TAGS = 1 + 2 * len(KINDS)


def char_ids(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
    out = np.where((points >= 32) & (points < 127), points - 31, np.where(points < 33, 96, np.where(points < 0x2000, 97, 98)))
    return out.astype(np.int16)


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


class Tagger:
    """BiLSTM with a CRF output layer; every parameter is in `p`."""

    def __init__(self, hidden: int = 16, seed: int = 5):
        rng, h = np.random.default_rng(seed), hidden
        self.h = h
        self.p = {}
        for d in "fb":
            self.p["W" + d] = rng.normal(0, 0.3, (_N_CHARS, 4 * h))
            self.p["W" + d][:, h:2 * h] += 1.0  # remember at first
            self.p["U" + d] = rng.normal(0, h ** -0.5, (h, 4 * h))
        self.p["V"] = rng.normal(0, (2 * h) ** -0.5, (2 * h, _N_TAGS))
        self.p["c"] = np.zeros(_N_TAGS)
        self.p["A"] = np.zeros((_N_TAGS, _N_TAGS))
        self.p["S"] = np.zeros(_N_TAGS)
        # inside follows the begin or inside of its own kind only
        self.banned = np.zeros((_N_TAGS, _N_TAGS), dtype=bool)
        for k in range(len(KINDS)):
            self.banned[:, 2 + 2 * k] = True
            self.banned[[1 + 2 * k, 2 + 2 * k], 2 + 2 * k] = False

    def _run(self, ids, d, keep=None):
        n, steps = ids.shape
        w, u, h = self.p["W" + d], self.p["U" + d], self.h
        out = np.zeros((steps, n, h), dtype=w.dtype)
        state, cell = np.zeros((n, h), dtype=w.dtype), np.zeros((n, h), dtype=w.dtype)
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = w[ids[:, t]] + state @ u
            gates, new = _sigmoid(z[:, :3 * h]), np.tanh(z[:, 3 * h:])
            before, cell = cell, gates[:, h:2 * h] * cell + gates[:, :h] * new
            squashed = np.tanh(cell)
            if keep is not None:
                keep[t] = (gates, new, before, squashed, state)
            state = gates[:, 2 * h:] * squashed
            out[t] = state
        return out

    def emissions(self, ids):
        """(characters, windows, tags)."""
        both = np.concatenate([self._run(ids, "f"), self._run(ids, "b")], axis=2)
        return both @ self.p["V"] + self.p["c"]

    def _chain(self, emit):
        """Scaled forward and backward sums; marginals."""
        a = np.where(self.banned, 0, np.exp(self.p["A"]))
        e = np.exp(emit - emit.max(axis=2, keepdims=True))
        steps = len(e)
        fwd, bwd = np.empty_like(e), np.empty_like(e)
        norm = np.empty(e.shape[:2])
        start = np.where(np.arange(_N_TAGS) % 2 + (np.arange(_N_TAGS) == 0) > 0, np.exp(self.p["S"]), 0)
        now = start * e[0]
        for t in range(steps):
            if t:
                now = (now @ a) * e[t]
            norm[t] = now.sum(axis=1)
            now = now / norm[t][:, None]
            fwd[t] = now
        now = np.ones_like(e[0])
        for t in range(steps - 1, -1, -1):
            bwd[t] = now
            if t:
                now = (now * e[t] / norm[t][:, None]) @ a.T
        return a, e, fwd, bwd, norm

    def loss_gradients(self, ids, tags):
        """Gradients of the negative log likelihood of (windows x characters) tags, per window."""
        keep_f, keep_b = {}, {}
        both = np.concatenate([self._run(ids, "f", keep_f), self._run(ids, "b", keep_b)], axis=2)
        emit = both @ self.p["V"] + self.p["c"]
        a, e, fwd, bwd, norm = self._chain(emit)
        n, steps = ids.shape
        marginal = fwd * bwd
        marginal /= marginal.sum(axis=2, keepdims=True)
        gold = np.eye(_N_TAGS)[tags.T]
        d_emit = (marginal - gold) / n
        g = {"S": d_emit[0].sum(axis=0), "A": np.zeros_like(self.p["A"])}
        for t in range(1, steps):
            g["A"] += fwd[t - 1].T @ (e[t] * bwd[t] / norm[t][:, None])
        g["A"] = (g["A"] * a - np.einsum("tni,tnj->ij", gold[:-1], gold[1:])) / n
        g["V"] = np.einsum("tnh,tnk->hk", both, d_emit)
        g["c"] = d_emit.sum(axis=(0, 1))
        d_both = d_emit @ self.p["V"].T
        h = self.h
        for d, keep, part in (("f", keep_f, d_both[:, :, :h]), ("b", keep_b, d_both[:, :, h:])):
            u = self.p["U" + d]
            gw, gu = np.zeros_like(self.p["W" + d]), np.zeros_like(u)
            d_state, d_cell = np.zeros((n, h)), np.zeros((n, h))
            for t in range(steps - 1, -1, -1) if d == "f" else range(steps):
                gates, new, before, squashed, state = keep[t]
                i, f, o = gates[:, :h], gates[:, h:2 * h], gates[:, 2 * h:]
                ds = part[t] + d_state
                dc = d_cell + ds * o * (1 - squashed * squashed)
                dz = np.concatenate([dc * new * i * (1 - i), dc * before * f * (1 - f), ds * squashed * o * (1 - o),
                                     dc * i * (1 - new * new)], axis=1)
                np.add.at(gw, ids[:, t], dz)
                gu += state.T @ dz
                d_state, d_cell = dz @ u.T, dc * f
            g["W" + d], g["U" + d] = gw, gu
        return g

    def train(self, ids, tags, steps: int = 400, batch: int = 48, rate: float = 0.01, seed: int = 3):
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(x) for k, x in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        order = np.zeros(0, dtype=np.int64)
        for t in range(1, steps + 1):
            if len(order) < batch:
                order = np.concatenate([order, rng.permutation(len(ids))])
            pick, order = order[:batch], order[batch:]
            g = self.loss_gradients(ids[pick], tags[pick])
            size = np.sqrt(sum((x * x).sum() for x in g.values()))
            step = rate * (1 - 0.9 * t / steps)
            for k in self.p:
                x = g[k] * min(1.0, 5.0 / (size + 1e-12))
                m[k] = 0.9 * m[k] + 0.1 * x
                v[k] = 0.999 * v[k] + 0.001 * x * x
                self.p[k] = self.p[k] - step * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)
        return self

    def decode(self, ids):
        """Best tag path and its marginals, each (windows x characters)."""
        emit = self.emissions(ids)
        a = np.where(self.banned, -1e9, self.p["A"])
        steps, n, k = emit.shape
        start = np.where((np.arange(k) > 0) & (np.arange(k) % 2 == 0), -1e9, self.p["S"])
        best, back = start + emit[0], np.zeros((steps, n, k), dtype=np.int8)
        for t in range(1, steps):
            through = best[:, :, None] + a
            back[t] = through.argmax(axis=1)
            best = through.max(axis=1) + emit[t]
        path = np.zeros((n, steps), dtype=np.int8)
        path[:, -1] = best.argmax(axis=1)
        for t in range(steps - 1, 0, -1):
            path[:, t - 1] = np.take_along_axis(back[t], path[:, t][:, None].astype(np.int64), axis=1)[:, 0]
        _, _, fwd, bwd, _ = self._chain(emit)
        marginal = fwd * bwd
        marginal /= marginal.sum(axis=2, keepdims=True)
        sure = np.take_along_axis(marginal.transpose(1, 0, 2), path[:, :, None].astype(np.int64), axis=2)[:, :, 0]
        return path, sure


def tags_of(length: int, spans) -> np.ndarray:
    """Tags of a text's characters; of overlapping spans the earlier in the list wins."""
    out = np.zeros(length, dtype=np.int8)
    for kind, a, b in spans:
        if b <= length and not out[a:b].any():
            out[a] = 1 + 2 * kind
            out[a + 1:b] = 2 + 2 * kind
    return out


def rewrite(rng, kind: int, value: str) -> str:
    """A form of a labelled value that the patterns miss."""
    digits = re.sub("[^0-9]", "", value)
    if kind == 0:
        return value.replace("@", " @ ") if rng.random() < 0.5 else value.replace("@", "[@]")
    if kind == 1:
        return value.replace(".", "[.]") if rng.random() < 0.5 else value.replace(".", " . ")
    if kind == 2:
        sep = "." if rng.random() < 0.5 else "/"
        return sep.join(digits[k:k + 4] for k in range(0, len(digits), 4))
    d = digits[-10:]
    return f"({d[:3]}) {d[3:6]}-{d[6:]}" if rng.random() < 0.5 else f"{d[:3]}-{d[3:6]}-{d[6:]}"


def training_windows(texts: list[str], size: int = 64, limit: int = 6000, seed: int = 1):
    """Windows around digits and `@` with the tags of the base spans; each labelled window also rewritten."""
    rng = np.random.default_rng(seed)
    ids, tags = [], []

    def add(part, spans):
        row, tag = np.zeros(size, dtype=np.int16), np.zeros(size, dtype=np.int8)
        part = part[:size]
        row[:len(part)], tag[:len(part)] = char_ids(part), tags_of(len(part), spans)
        ids.append(row), tags.append(tag)

    for text in texts:
        spans, past = base_spans(text), -1
        for m in _SIGNAL.finditer(text):
            if m.start() < past:
                continue
            start = max(0, m.start() - int(rng.integers(8, 28)))
            past = start + size
            inside = [(k, a - start, b - start) for k, a, b in spans if start <= a and b <= past]
            if any(a < past < b or a < start < b for _, a, b in spans):
                continue
            add(text[start:past], inside)
            if inside:
                k, a, b = inside[0]
                part = text[start:past]
                value = rewrite(rng, k, part[a:b])
                add(part[:a] + value + part[b:], [(k, a, a + len(value))])
            if len(ids) >= limit:
                return np.stack(ids), np.stack(tags)
    return (np.stack(ids), np.stack(tags)) if ids else (None, None)


def reconcile(base, found) -> list[tuple[int, int, int]]:
    """Spans of a document from base spans and the windows' spans (kind, start, end, confidence)."""
    joined: list[list] = []
    for kind, a, b, sure in sorted(found):
        if joined and joined[-1][0] == kind and a < joined[-1][2]:
            last = joined[-1]
            last[2], last[3] = max(last[2], b), max(last[3], sure)
        else:
            joined.append([kind, a, b, sure])
    fixed = sorted((a, b) for _, a, b in base)
    starts = np.array([a for a, _ in fixed])
    reach = np.maximum.accumulate([b for _, b in fixed]) if fixed else starts
    free = []
    for kind, a, b, sure in joined:
        k = int(np.searchsorted(starts, b)) - 1  # base spans that begin before b
        if k < 0 or reach[k] <= a:
            free.append((b, a, kind, sure * (b - a)))
    free.sort()
    ends = [f[0] for f in free]
    total, take = [0.0], []
    for j, (b, a, kind, weight) in enumerate(free):
        before = int(np.searchsorted(ends[:j], a, side="right"))
        use = total[before] + weight > total[j]
        total.append(total[before] + weight if use else total[j])
        take.append((use, before))
    out, j = list(base), len(free)
    while j:
        use, before = take[j - 1]
        if use:
            b, a, kind, _ = free[j - 1]
            out.append((kind, a, b))
        j = before if use else j - 1
    return sorted(out)


class Finder:
    """Runs a tagger over the windows of whole texts."""

    def __init__(self, tagger: Tagger | None, window: int = 128, stride: int = 64, group: int = 512,
                 confidence: float = 0.9, shortest: int = 7):
        self.tagger, self.window, self.stride, self.group = tagger, window, stride, group
        self.confidence, self.shortest = confidence, shortest

    def spans(self, texts: list[str]) -> list[tuple[list, list]]:
        """(base spans, all spans) of each text, sorted by kind and start."""
        base = [sorted(base_spans(t)) for t in texts]
        found: list[list] = [[] for _ in texts]
        if self.tagger is not None:
            where = []
            for k, t in enumerate(texts):
                last = -1
                for m in _SIGNAL.finditer(t):
                    at = m.start() // self.stride
                    for w in range(max(last + 1, at - self.window // self.stride + 1, 0), at + 1):
                        where.append((k, w * self.stride))
                    last = max(last, at)
                    if len(where) >= self.group:
                        self._tag(texts, where[:], found)
                        where.clear()
            if where:
                self._tag(texts, where, found)
        return [(b, reconcile(b, f)) for b, f in zip(base, found)]

    def _tag(self, texts, where, found):
        ids = np.zeros((len(where), self.window), dtype=np.int16)
        for row, (k, a) in enumerate(where):
            part = char_ids(texts[k][a:a + self.window])
            ids[row, :len(part)] = part
        path, sure = self.tagger.decode(ids)
        for row in np.flatnonzero(path.any(axis=1)):
            k, origin = where[row]
            tags = path[row]
            text = texts[k]
            begins = np.flatnonzero(tags & 1)
            for a in begins.tolist():
                kind, b = (int(tags[a]) - 1) // 2, a + 1
                while b < self.window and tags[b] == 2 + 2 * kind:
                    b += 1
                value = text[origin + a:origin + b]
                certain = float(sure[row, a:b].min())
                if certain >= self.confidence and len(value) >= self.shortest and b - a == len(value) \
                        and _SIGNAL.search(value):
                    found[k].append((kind, origin + a, origin + b, certain))


def spell(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def fit(docs: DataFrame, train_docs: int = 1500, doc_windows: int = 20, id_col: str = "doc_id", text_col: str = "text",
        hidden: int = 16, steps: int = 400) -> Tagger | None:
    """Tagger from the base spans of a bounded sample: at most `train_docs` documents, and about
    `doc_windows` windows of each (with their rewritten forms at most twice as many)."""
    rows = docs.where(F.col(id_col).isNotNull() & F.col(text_col).rlike("[0-9@]"))
    narrow = rows.select(F.xxhash64(id_col).alias("_h"), F.col(id_col).alias("_id")).distinct().orderBy("_h", "_id").limit(train_docs)
    sample = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t")).join(F.broadcast(narrow), "_id")

    def windows(batches):
        for batch in batches:
            hashes, ids, tags = [], [], []
            for h, text in zip(batch.column("_h").to_pylist(), batch.column("_t").to_pylist()):
                i, t = training_windows([text], limit=doc_windows, seed=h & 0xFFFF)
                if i is None:  # a span across every window's edge
                    continue
                hashes += [h] * len(i)
                ids += [x.tobytes() for x in i[:2 * doc_windows]]
                tags += [x.tobytes() for x in t[:2 * doc_windows]]
                hashes = hashes[:len(ids)]
            yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.int64()), pa.array(ids, pa.binary()), pa.array(tags, pa.binary())],
                                             names=["h", "ids", "tags"])

    rows = sample.select("_h", "_t").mapInArrow(windows, "h bigint, ids binary, tags binary").collect()
    if not rows:
        return None
    rows = sorted((r["h"], bytes(r["ids"]), bytes(r["tags"])) for r in rows)  # the rows come in any order
    ids = np.stack([np.frombuffer(i, dtype=np.int16) for _, i, _ in rows])
    tags = np.stack([np.frombuffer(t, dtype=np.int8) for _, _, t in rows])
    return Tagger(hidden).train(ids, tags, steps)


def find(docs: DataFrame, tagger: Tagger | None, finish, schema: str, id_col: str = "doc_id",
         text_col: str = "text", keep: list[str] | None = None, batch_chars: int = 1 << 22) -> DataFrame:
    """One row per row: the columns `keep` (default: the id) and what `finish(text, base, spans)` returns.

    A worker works on about `batch_chars` bytes of text (or one longer text) at a time.
    """
    keep = keep or [id_col]
    columns = keep if text_col in keep else [*keep, text_col]  # the text travels once
    at = columns.index(text_col)
    docs = docs.select(*[F.col(f"`{c}`") for c in columns])
    finder = Finder(tagger)
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    added = StructType.fromDDL(schema)
    arrow = list(to_arrow_schema(added))

    def run(batches):
        for whole in batches:
            for batch in slices_of_rows(whole, at, batch_chars):
                texts = [t or "" for t in batch.column(at).to_pylist()]
                rows = [finish(t, b, s) for t, (b, s) in zip(texts, finder.spans(texts))]
                results = zip(*rows) if rows else [[] for _ in arrow]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:len(keep)], *(pa.array(c, f.type) for c, f in zip(results, arrow))],
                    names=[*keep, *(f.name for f in arrow)])

    return docs.mapInArrow(run, StructType([*docs.schema.fields[:len(keep)], *added.fields]))


def digest(text, base, spans):
    """What the registered query reports of a document."""
    return (*(sum(k == kind for k, _, _ in base) for kind in range(4)), hashlib.sha256(spell(base).encode()).hexdigest(),
            spell(spans))


DIGEST = "n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string"


def redact(text, base, spans):
    """The text with every span replaced by its kind in brackets (overlapping spans: one, the first's kind)."""
    out, past = [], 0
    for a, b, kind in sorted((a, b, k) for k, a, b in spans):
        if a >= past:
            out += [text[past:a], f"[{KINDS[kind].upper()}]"]
            past = b
        elif b > past:
            past = b
    return ("".join([*out, text[past:]]),)

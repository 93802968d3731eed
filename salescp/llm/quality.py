"""Quality classifier learned from trusted positives and unlabelled text.

Positive-unlabelled learning: a small network minimises the non-negative
unbiased risk  pi * R_P(+) + max(0, R_U(-) - pi * R_P(-)),  where pi is the
share of positives among the unlabelled texts, estimated beforehand from how
far a positive-against-unlabelled scorer can separate the two samples.  Labels
other than the trusted positives are never used.

Scale.  Features are computed where the texts lie, in one pass without a
shuffle.  Learning takes a bounded sample (`positives` and `unlabelled` rows,
the ones of smallest id hash); only its feature vectors reach the driver, as
1,120 bytes each.

Defined results: a null text counts as empty and gets the score of an empty
text; a text of any length is read whole; with no trusted positive every score
is 0.5; a label row that repeats counts once, null labels and ids teach nothing;
null and repeated ids are scored like any other row; an empty table gives no
rows; columns of `docs` other than id and text are not read by `classify` and
pass through `score`, but for one named `_score`, which is replaced.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_bucket

# byte classes: a-z, A-Z, 0-9, space, newline, other white, . , ! ? ' " - _ sign groups, UTF-8 lead, UTF-8 rest
_GROUPS = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n", b"\t\r\x0b\x0c", b".",
           b",;:", b"!?", b"'\"`", b"-_", b"|/\\", b"()[]{}<>", bytes(range(0xC0, 0x100)), bytes(range(0x80, 0xC0))]
_CLASS = np.full(256, 15, dtype=np.uint8)
for _k, _g in enumerate(_GROUPS):
    _CLASS[list(_g)] = _k
N_FEATURES = 256 + 16 + 8


def features(text: str | None) -> np.ndarray:
    """Square roots of byte-class pair and class shares, and word and line statistics, of the whole text."""
    out = np.zeros(N_FEATURES, dtype=np.float32)
    text = text or ""
    kinds = _CLASS[np.frombuffer(text.encode(), dtype=np.uint8)]
    if len(kinds):
        out[256:272] = np.sqrt(np.bincount(kinds, minlength=16) / len(kinds))
    if len(kinds) > 1:
        out[:256] = np.sqrt(np.bincount((kinds[:-1] << 4) | kinds[1:], minlength=256) / (len(kinds) - 1))
    words = text.split()
    if words:
        count = Counter(words)
        lines = text.split("\n")
        out[272:] = (np.log1p(len(text)) / 10, np.log1p(len(words)) / 10, len(count) / len(words),
                     max(count.values()) / len(words), len(set(lines)) / len(lines), np.log1p(len(lines)) / 10,
                     min(len(text) / len(words), 50) / 10, np.log1p(len(count)) / 10)
    return out


class Network:
    """One hidden layer; `train` minimises the non-negative PU risk with Adam."""

    def __init__(self, hidden: int = 24, seed: int = 7):
        self.hidden, self.rng = hidden, np.random.default_rng(seed)

    def _start(self, x):
        self.mean, self.std = x.mean(axis=0), x.std(axis=0) + 0.02
        n = x.shape[1]
        self.w = [self.rng.normal(0, n ** -0.5, (n, self.hidden)), np.zeros(self.hidden),
                  self.rng.normal(0, self.hidden ** -0.5, self.hidden), np.zeros(1)]

    def value(self, x):
        h = np.tanh(((x - self.mean) / self.std) @ self.w[0] + self.w[1])
        return h @ self.w[2] + self.w[3][0]

    def gradients(self, p, u, prior):
        """(unlabelled less positive part of the risk, gradients of what a step descends) of standardised rows.

        The risk, while that part is not negative; else the part's negative, the step back.
        """
        x = np.concatenate([p, u])
        h = np.tanh(x @ self.w[0] + self.w[1])
        s = 1 / (1 + np.exp(-np.clip(h @ self.w[2] + self.w[3][0], -40, 40)))
        sp, su = s[:len(p)], s[len(p):]
        # logistic loss: l(+) = -log s, l(-) = -log(1 - s); derivatives s - 1 and s
        negative = -np.log1p(-np.minimum(su, 1 - 1e-12)).mean() + prior * np.log1p(-np.minimum(sp, 1 - 1e-12)).mean()
        if negative >= 0:
            g = np.concatenate([prior * ((sp - 1) - sp) / len(sp), su / len(su)])
        else:  # the negative part went below zero: step back along it alone
            g = np.concatenate([prior * sp / len(sp), -su / len(su)])
        back = np.outer(g, self.w[2]) * (1 - h * h)
        return negative, [x.T @ back, back.sum(axis=0), h.T @ g, np.array([g.sum()])]

    def train(self, pos, unl, prior, rounds=80, batch=512, rate=2e-3, decay=1e-4):
        self._start(np.concatenate([pos, unl]))
        p, u = ((x - self.mean) / self.std for x in (pos, unl))
        m, v, t = [np.zeros_like(w) for w in self.w], [np.zeros_like(w) for w in self.w], 0
        steps = max(1, -(-len(u) // batch))
        for _ in range(rounds):
            pi, ui = self.rng.permutation(len(p)), self.rng.permutation(len(u))
            for part_p, part_u in zip(np.array_split(pi, steps), np.array_split(ui, steps)):
                if not len(part_p) or not len(part_u):
                    continue
                grads = self.gradients(p[part_p], u[part_u], prior)[1]
                t += 1
                for k, grad in enumerate(grads):
                    grad = grad + decay * self.w[k]
                    m[k] = 0.9 * m[k] + 0.1 * grad
                    v[k] = 0.999 * v[k] + 0.001 * grad * grad
                    self.w[k] = self.w[k] - rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)
        return self


def class_prior(pos: np.ndarray, unl: np.ndarray, seed: int = 11, folds: int = 3) -> float:
    """Share of positives among the unlabelled rows.

    Out-of-fold scores of positive against unlabelled rows; at every cut, the share of
    unlabelled rows that score above it over the share of positives that do bounds the
    prior from above, up to sampling error, of which half a standard deviation is added.
    """
    rng = np.random.default_rng(seed)
    sp, su = np.zeros(len(pos)), np.zeros(len(unl))
    fp, fu = rng.integers(0, folds, len(pos)), rng.integers(0, folds, len(unl))
    for k in range(folds):
        if not (fp != k).any() or not (fu != k).any():
            continue
        x = np.concatenate([pos[fp != k], unl[fu != k]])
        y = np.concatenate([np.ones((fp != k).sum()), np.zeros((fu != k).sum())])
        net = Network(seed=seed)
        # with prior 1/2 and no correction this risk is the plain logistic one of the two samples
        net._start(x)
        _logistic(net, (x - net.mean) / net.std, y)
        sp[fp == k], su[fu == k] = net.value(pos[fp == k]), net.value(unl[fu == k])
    return prior_bound(sp, su)


def prior_bound(sp: np.ndarray, su: np.ndarray) -> float:
    """The least bound over all cuts of the scores of positive (`sp`) and unlabelled rows (`su`)."""
    cuts = np.quantile(np.concatenate([sp, su]), np.linspace(0, 0.98, 99))
    a = (sp[None, :] >= cuts[:, None]).mean(axis=1)
    b = (su[None, :] >= cuts[:, None]).mean(axis=1)
    good = a >= 0.2
    error = 0.5 * np.sqrt(np.maximum(b * (1 - b), 1e-9) / len(su)) + 0.5 * np.sqrt(np.maximum(a * (1 - a), 1e-9) / len(sp))
    return float(np.clip(((b + error) / np.maximum(a, 1e-9))[good].min(), 0.02, 0.98))


def _logistic(net: Network, x, y, rounds=15, batch=512, rate=3e-3):
    m, v, t = [np.zeros_like(w) for w in net.w], [np.zeros_like(w) for w in net.w], 0
    weight = np.where(y > 0, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    for _ in range(rounds):
        for part in np.array_split(net.rng.permutation(len(x)), max(1, len(x) // batch)):
            h = np.tanh(x[part] @ net.w[0] + net.w[1])
            s = 1 / (1 + np.exp(-np.clip(h @ net.w[2] + net.w[3][0], -40, 40)))
            g = weight[part] * (s - y[part]) / len(part)
            back = np.outer(g, net.w[2]) * (1 - h * h)
            t += 1
            for k, grad in enumerate([x[part].T @ back, back.sum(axis=0), h.T @ g, np.array([g.sum()])]):
                m[k] = 0.9 * m[k] + 0.1 * grad
                v[k] = 0.999 * v[k] + 0.001 * grad * grad
                net.w[k] = net.w[k] - rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)


def with_features(docs: DataFrame, keep: str, text_col: str) -> DataFrame:
    """(`keep`, f): feature vectors of the texts, as little-endian 32-bit floats."""
    docs = docs.select(keep, F.col(text_col).alias("text"))

    def run(batches):
        for batch in batches:
            rows = [features(t).astype("<f4").tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], names=[keep, "f"])

    return docs.mapInArrow(run, f"{keep} {docs.schema[0].dataType.simpleString()}, f binary")


def feature_rows(blobs: list[bytes]) -> np.ndarray:
    """Matrix of `with_features` vectors; rows sorted, as they come in any order and learning is to be repeatable."""
    x = np.frombuffer(b"".join(blobs), dtype="<f4").reshape(-1, N_FEATURES)
    return x[np.lexsort(x.T)]


def fit(docs: DataFrame, labels: DataFrame, positives: int = 4000, unlabelled: int = 8000, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "quality") -> Network | None:
    """Network from at most `positives` trusted positives of `labels` and `unlabelled` rows of `docs`."""
    trusted = (labels.where((F.col(label_col) == 1) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id")).distinct())
    first = (trusted.select("_id", F.xxhash64("_id").alias("_h")).orderBy("_h", "_id").limit(positives)
             .select("_id", F.lit(1).alias("tag")))
    # the unlabelled sample: its own hash, so that it does not follow the choice of the positives
    some = (docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id")).distinct()
            .select("_id", F.xxhash64(F.lit("u"), "_id").alias("_h")).orderBy("_h", "_id").limit(unlabelled)
            .select("_id", F.lit(0).alias("tag")))
    wanted = first.union(some)
    rows = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
            .join(F.broadcast(wanted), "_id").select("tag", "text"))
    sample = with_features(rows, "tag", "text").toArrow()  # at most 12,000 vectors of 1,120 bytes
    tags, blobs = sample.column("tag").to_pylist(), sample.column("f").to_pylist()
    pos, unl = (feature_rows([f for f, t in zip(blobs, tags) if t == k]) for k in (1, 0))
    del sample, blobs
    if not len(pos) or not len(unl):
        return None
    net = Network()
    net.prior = class_prior(pos, unl)
    return net.train(pos, unl, net.prior)


def score(docs: DataFrame, net: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of `docs` with `_score` (0 to 1, higher: a positive is likelier); a column of that name is replaced."""
    docs = docs.drop("_score")
    if net is None:
        return docs.withColumn("_score", F.lit(0.5))
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            value = [net.value(np.stack([features(t) for t in batch.column(at).slice(a, 256).to_pylist()]).astype(np.float64))
                     for a in range(0, batch.num_rows, 256)]
            value = np.clip(np.concatenate(value) if value else np.zeros(0), -40, 40)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(1 / (1 + np.exp(-value)), pa.float64())],
                                             names=[*batch.schema.names, "_score"])

    from pyspark.sql.types import DoubleType, StructType

    schema = StructType([*docs.schema.fields]).add("_score", DoubleType())
    return docs.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality", folds: int = 3, held_out: int = 1, **sample) -> DataFrame:
    """Learn outside one id fold, score everywhere: (id, held_out, score, predicted)."""
    fold = id_bucket(id_col, folds)
    net = fit(docs.where(fold != held_out), labels.where(fold != held_out), id_col=id_col, text_col=text_col,
              label_col=label_col, **sample)
    out = score(docs.select(F.col(id_col), F.col(text_col).alias("text")), net, id_col)
    return out.select(id_col, F.coalesce(fold == held_out, F.lit(False)).alias("held_out"), F.col("_score").alias("score"),
                      (F.col("_score") >= 0.5).cast("int").alias("predicted"))

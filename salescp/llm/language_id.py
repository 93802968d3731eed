"""Language identification by unigram pieces, summed over all segmentations.

Each language has a probability for each piece of a fixed public vocabulary (all
of them, in lower case, and every byte).
The likelihood of a word is the sum over every way to cut it into pieces of the
product of their probabilities, by a forward pass over its bytes; a text's
score adds the logs over its words and a prior.  The piece probabilities are
learned by expectation maximisation (forward-backward) from labelled texts.

Scale.  Learning takes a bounded sample (`train_docs` texts and `train_chars`
characters a language, the ones of smallest id hash), one language per task;
the model (languages x pieces) is broadcast and does not grow with the data.
Prediction is one pass without a shuffle: a worker scores each distinct chunk
of a batch once, in blocks of equal length, and keeps a bounded cache.

Defined results: a null text, or one without a letter, is `und` with score 0;
so is every text when there is no labelled row.  Ties go to the language that
sorts first.  Rows with a null id or label teach nothing; null and repeated ids
are predicted like any other row.  A text of any length is read whole; an empty
table gives no rows; columns other than id, text and label are not read.
"""

from __future__ import annotations

import base64
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import HELD_CHARS, slices
from .common import id_bucket, worker_store

UND = "und"
SLOTS = 8
_LETTERS = regex.compile(r"\p{L}+")


class Pieces:
    """Vocabulary of byte pieces, as a trie, with a look-up of all substrings of a block of words."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            tokens = {base64.b64decode(line.split()[0]).lower() for line in f} | {bytes([b]) for b in range(256)}
        self.tokens = sorted(t for t in tokens if t)
        self.single = np.flatnonzero([len(t) == 1 for t in self.tokens])
        # a node for each prefix, the empty one is 0; a step is keyed by its node and byte
        nodes, steps = {b"": 0}, []
        for t in self.tokens:
            for size in range(1, len(t) + 1):
                if t[:size] not in nodes:
                    nodes[t[:size]] = len(nodes)
                    steps.append(nodes[t[:size - 1]] + 1 << 8 | t[size - 1])
        self.dead = len(nodes)
        self.piece = np.full(self.dead + 1, len(self.tokens), dtype=np.int32)
        self.piece[[nodes[t] for t in self.tokens]] = np.arange(len(self.tokens))
        keys = np.array(steps, dtype=np.uint64)
        self.log = max(4, (len(keys) // 3).bit_length())
        while True:
            home = self._home(keys)
            order = np.argsort(home, kind="stable")
            slot = np.arange(len(keys)) - np.searchsorted(home[order], home[order])
            if slot.max() < SLOTS:
                break
            self.log += 1
        self.keys = np.zeros((1 << self.log, SLOTS), dtype=np.uint64)
        self.to = np.full((1 << self.log, SLOTS), self.dead, dtype=np.int32)
        self.keys[home[order], slot] = keys[order]
        self.to[home[order], slot] = order + 1

    def _home(self, keys):
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.log)).astype(np.int64)

    def lookup(self, block: np.ndarray) -> list[np.ndarray]:
        """For l = 1, 2, ..: ids (words x starts) of the substrings of l bytes; len(tokens): none.

        Ends with the last length that a substring has.
        """
        out, n = [], block.shape[1]
        node = np.zeros(block.shape, dtype=np.int32)
        for size in range(1, n + 1):
            node = node[:, :n - size + 1].copy()
            alive = np.nonzero(node != self.dead)
            if not len(alive[0]):
                break
            key = (node[alive].astype(np.uint64) + np.uint64(1)) << np.uint64(8) | block[:, size - 1:][alive].astype(np.uint64)
            home = self._home(key)
            node[alive] = np.where(self.keys[home] == key[:, None], self.to[home], self.dead).min(axis=1)
            out.append(self.piece[node])
        while out and (out[-1] == len(self.tokens)).all():
            out.pop()
        return out


def blocks(words: list[bytes], cells: int = 200_000):
    """(indices, words x bytes) of words of one length, about `cells` bytes at a time."""
    if not words:
        return
    lengths = np.array([len(w) for w in words])
    order = np.argsort(lengths, kind="stable")
    cuts = np.flatnonzero(np.concatenate(([True], np.diff(lengths[order]) != 0, [True])))
    for a, b in zip(cuts[:-1], cuts[1:]):
        size = int(lengths[order[a]])
        if not size:
            continue
        step = max(1, cells // size)
        for c in range(a, b, step):
            index = order[c:min(b, c + step)]
            yield index, np.frombuffer(b"".join(words[i] for i in index), dtype=np.uint8).reshape(len(index), size)


def in_range(prob: np.ndarray, pieces: Pieces, size: int) -> bool:
    """Whether the sums of a word of this many bytes stay far above the smallest double, whatever its bytes."""
    low = prob[pieces.single].min()
    return low > 0 and size * -np.log(low) < 600


def log_likelihood(pieces: Pieces, prob: np.ndarray, words: list[bytes]) -> np.ndarray:
    """Forward pass: log of the sum over all segmentations, for each word and language.

    `prob` has a last row of zeros for substrings that are no piece.
    """
    out = np.zeros((len(words), prob.shape[1]))
    none, log_prob = len(pieces.tokens), np.log(np.maximum(prob, 1e-300))
    for index, block in blocks(words):
        ids, linear = pieces.lookup(block), in_range(prob, pieces, block.shape[1])
        # sums at the last places; of long words their logs
        recent = [np.full((len(index), prob.shape[1]), float(linear))]
        for end in range(1, block.shape[1] + 1):
            total = np.full_like(recent[0], 0.0 if linear else -np.inf)
            for size in range(1, min(len(ids), end) + 1):
                piece = ids[size - 1][:, end - size]
                who = np.flatnonzero(piece != none)
                if not len(who):
                    continue
                if linear:
                    total[who] += recent[-size][who] * prob[piece[who]]
                else:
                    total[who] = np.logaddexp(total[who], recent[-size][who] + log_prob[piece[who]])
            recent = [*recent[-len(ids) + 1:], total] if len(ids) > 1 else [total]
        out[index] = np.log(np.maximum(recent[-1], 1e-290)) if linear else recent[-1]
    return out


def learn(pieces: Pieces, words: dict[bytes, int], rounds: int = 4, smooth: float = 0.5) -> np.ndarray:
    """Piece probabilities of one language by expectation maximisation over its words, however long."""
    n = len(pieces.tokens)
    sizes = np.array([len(t) for t in pieces.tokens])
    prob = np.append(0.02 ** (sizes - 1.0) / 256, 0)
    prob /= prob.sum()
    names, counts = list(words), np.array(list(words.values()), dtype=float)
    for _ in range(rounds):
        expected = np.zeros(n + 1)
        for index, block in blocks(names):
            ids, size_of = pieces.lookup(block), block.shape[1]
            hits = [np.nonzero(i != n) for i in ids]
            if in_range(prob, pieces, size_of):
                fwd, bwd = np.zeros((2, size_of + 1, len(index)))
                fwd[0] = bwd[size_of] = 1
                for end in range(1, size_of + 1):
                    for s in range(1, min(len(ids), end) + 1):
                        fwd[end] += fwd[end - s] * prob[ids[s - 1][:, end - s]]
                for start in range(size_of - 1, -1, -1):
                    for s in range(1, min(len(ids), size_of - start) + 1):
                        bwd[start] += bwd[start + s] * prob[ids[s - 1][:, start]]
                weight = counts[index] / fwd[-1]
                share = [fwd[start, word] * prob[i[word, start]] * bwd[start + s, word] * weight[word]
                         for s, (i, (word, start)) in enumerate(zip(ids, hits), 1)]
            else:  # the sums of long words by their logs
                with np.errstate(divide="ignore"):
                    log_prob = np.log(prob)
                fwd, bwd = np.full((2, size_of + 1, len(index)), -np.inf)
                fwd[0] = bwd[size_of] = 0
                for end in range(1, size_of + 1):
                    for s in range(1, min(len(ids), end) + 1):
                        fwd[end] = np.logaddexp(fwd[end], fwd[end - s] + log_prob[ids[s - 1][:, end - s]])
                for start in range(size_of - 1, -1, -1):
                    for s in range(1, min(len(ids), size_of - start) + 1):
                        bwd[start] = np.logaddexp(bwd[start], bwd[start + s] + log_prob[ids[s - 1][:, start]])
                share = [np.exp(fwd[start, word] + log_prob[i[word, start]] + bwd[start + s, word] - fwd[-1, word])
                         * counts[index][word] for s, (i, (word, start)) in enumerate(zip(ids, hits), 1)]
            for i, (word, start), x in zip(ids, hits, share):
                expected += np.bincount(i[word, start], x, minlength=n + 1)
        expected[n] = 0
        prob = expected + smooth / 10
        prob[:n][sizes == 1] += smooth
        prob[n] = 0
        prob /= prob.sum()
    return prob


def words_of(text: str) -> list[bytes]:
    """Letter runs, lower-cased, each with a leading space."""
    return [b" " + w.encode() for w in _LETTERS.findall(text.lower())]


def fit(labelled: DataFrame, path: str, train_docs: int = 400, train_chars: int = 1_500_000, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "lang", most_labels: int = 256):
    """(languages, log priors, probabilities) from a bounded sample of labelled rows.

    Rows: the `train_docs` of smallest id hash for each label, up to `train_chars`
    characters in all; priors: label shares over all rows of these labels.  The
    `most_labels` labels of most rows are learned (about 170 KB of model each), so
    stray label values cannot make the model grow.
    """
    rows = labelled.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    most = (rows.groupBy(F.col(label_col).alias("l")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "l").limit(most_labels)
            .collect())
    rows = rows.where(F.col(label_col).isin([r["l"] for r in most]))
    narrow = rows.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label"), F.xxhash64(id_col).alias("_h"))
    first = (narrow.withColumn("_k", F.row_number().over(Window.partitionBy("_label").orderBy("_h", "_id")))
             .where(F.col("_k") <= train_docs))
    sample = (rows.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label"), F.col(text_col).alias("_text"))
              .join(F.broadcast(first), ["_id", "_label"]).select("_label", "_k", "_text"))

    def one(key, frame):
        frame = frame.sort_values("_k", kind="stable").drop_duplicates("_k")
        frame = frame[frame["_text"].str.len().cumsum() - frame["_text"].str.len() < train_chars]
        counts: dict[bytes, int] = {}
        for t in frame["_text"]:
            for w in words_of(t):
                counts[w] = counts.get(w, 0) + 1
        prob = learn(Pieces(path), counts)
        return pd.DataFrame({"label": [str(key[0])], "prob": [prob.astype(np.float32).tobytes()]})

    model = {r["label"]: np.frombuffer(bytes(r["prob"]), dtype=np.float32)
             for r in sample.groupBy("_label").applyInPandas(one, "label string, prob binary").collect()}
    share = {str(r["l"]): r["n"] for r in most}
    names = sorted(model)
    total = sum(share[x] for x in names)
    prior = np.log([share[x] / total for x in names])
    return names, prior, np.stack([model[x] for x in names], axis=1).astype(np.float64) if names else None


class Scorer:
    """Log likelihoods of the distinct chunks that a worker has met."""

    def __init__(self, path: str, prob: np.ndarray, cache_entries: int = 500_000):
        self.pieces, self.prob, self.limit = Pieces(path), prob, cache_entries
        self._clear()

    def _clear(self):
        self.held = 0
        self.row: dict[str, int] = {}
        self.scores = np.zeros((0, self.prob.shape[1]))
        self.lettered = np.zeros(0, dtype=bool)

    def prepare(self, texts: list[str]) -> None:
        if len(self.row) > self.limit or self.held > HELD_CHARS:
            self._clear()
        need: set[str] = set()
        for t in texts:
            need.update(t.replace("\n", " ").split(" "))
        need.difference_update(self.row)
        self.held += sum(map(len, need))
        chunks = list(need)
        words = [words_of(c) for c in chunks]
        known = {w: k for k, w in enumerate({w for ws in words for w in ws})}
        each = log_likelihood(self.pieces, self.prob, list(known))
        owner = np.repeat(np.arange(len(words)), [len(ws) for ws in words])
        which = np.array([known[w] for ws in words for w in ws], dtype=np.int64)
        sums = np.zeros((len(chunks), self.prob.shape[1]))
        for k in range(sums.shape[1]):
            sums[:, k] = np.bincount(owner, each[which, k], minlength=len(chunks))
        self.row.update(zip(chunks, range(len(self.scores), len(self.scores) + len(chunks))))
        self.scores = np.concatenate([self.scores, sums])
        self.lettered = np.concatenate([self.lettered, np.array([bool(ws) for ws in words], dtype=bool)])

    def score(self, text: str):
        """Sum over the words of a prepared text; None without a letter."""
        rows = np.fromiter(map(self.row.__getitem__, text.replace("\n", " ").split(" ")), dtype=np.int64)
        return self.scores[rows].sum(axis=0) if self.lettered[rows].any() else None


def predict(docs: DataFrame, model, path: str, id_col: str = "doc_id", text_col: str = "text",
            batch_chars: int = 1 << 25) -> DataFrame:
    """(id, lang_pred, score): the likeliest language and its posterior."""
    names, prior, prob = model
    docs = docs.select(docs[id_col].alias(id_col), docs[text_col].alias("text"))
    schema = f"{id_col} {docs.schema[0].dataType.simpleString()}, lang_pred string, score double"
    if not names:
        return docs.selectExpr(f"`{id_col}`", f"'{UND}' as lang_pred", "0D as score")
    shared = docs.sparkSession.sparkContext.broadcast(prob)
    name = uuid.uuid4().hex  # the worker's scorer belongs to this model

    def run(batches):
        store = worker_store("language")
        if name not in store:
            store.clear()
            store[name] = Scorer(path, shared.value)
        scorer = store[name]
        for batch in batches:
            label, score = [], []
            for part in slices(batch.column(1).to_pylist(), batch_chars):
                scorer.prepare(part)
                for text in part:
                    total = scorer.score(text)
                    if total is None:
                        label.append(UND), score.append(0.0)
                        continue
                    total = total + prior
                    best = int(total.argmax())
                    label.append(names[best])
                    score.append(float(1 / np.exp(total - total[best]).sum()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(label, pa.string()), pa.array(score, pa.float64())],
                                             names=[id_col, "lang_pred", "score"])

    return docs.mapInArrow(run, schema)


def identify(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
             folds: int = 5, held_out: int = 0, **sample) -> DataFrame:
    """Learn outside one id fold, predict everywhere: (id, held_out, lang_pred, score)."""
    fold = id_bucket(id_col, folds)
    model = fit(docs.where(fold != held_out), path, id_col=id_col, text_col=text_col, label_col=label_col, **sample)
    out = predict(docs, model, path, id_col, text_col)
    return out.select(id_col, F.coalesce(fold == held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")

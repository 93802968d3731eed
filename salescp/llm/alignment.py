"""Alignment of two tokenizers over a corpus, with an identity-map fast path.

Both tokenizers encode the same bytes (a space and the text).  The places where
a token of each ends cut the tokens into groups; within a group every pair of
tokens whose byte ranges overlap is a link, and a pair of ids counts as often as
links hold it over the whole corpus.

1. Identity map: for every id of A the id of B with the same bytes, an array made
   once from the two vocabularies.  A group of one token each whose ids the map
   joins is counted in a vector as long as A's vocabulary, kept per task.
2. All other groups are irregular; only their links become id pairs, added up per
   task before the one shuffle that counts pairs.
3. The best count of each B id is the largest over its pairs.
4. Each document's sums: the map's pairs and the (at most `known_pairs`) pairs of
   highest count are looked up where the documents lie; the rest, all of them rare
   by then, go through a join on the pair.  Every pair takes one of the two ways,
   so the result does not depend on `known_pairs`.

A text is aligned unit by unit: it is cut at single spaces between other
characters.  No piece of B has a space behind another character (checked, else
texts are taken whole) and A's pattern begins a pre-token there, so both encode a
unit as they encode it within its text; units are aligned once per worker and
batch of texts and kept in a bounded cache.

Scale.  Two passes of Python over the documents, the second over written arrays of
ids.  Through the driver and broadcast: the identity map's counts (the size of A's
vocabulary) and `known_pairs` pairs.  No hot pair is shuffled by document: what is
common is looked up.

Defined results: a null or empty text, and one whose bytes a tokenizer does not
give back (it holds U+2581, which B reads as a space), has no tokens, zeros and an
empty digest; strings of special tokens are plain text; null and repeated ids are
kept, one result per row; an empty table gives no rows; a text of any length is
aligned whole; columns other than id and text are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescp.session import materialize

from .bpe import slices
from .common import worker_store

_ODD = re.compile(r" \s|\A | \Z")
_CUT = re.compile(r"(?<=[^ ]) (?=\S)")
HELD_CHARS = 1 << 24  # characters of the units that the cache may hold


def units(text: str) -> list[str]:
    """The text cut at its single spaces that stand between a non-space and a non-white character."""
    return text.split(" ") if _ODD.search(text) is None else _CUT.split(text)


def byte_of_letter() -> dict[str, int]:
    """The letters by which a byte-level vocabulary spells bytes: printable Latin-1 itself, the others from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in own}
    return out | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(own))}


LONG = 2000  # characters of a unit from which on the tokenizer's own heap is quicker than ranks piece by piece


class Vocabularies:
    """Both tokenizers, the bytes of their tokens, and the identity map.

    `pattern`: the pre-token pattern of A.  If given, and A is a plain byte-level BPE whose ids follow its merges, units
    are encoded by the ranks of its pieces, which gives the same ids quicker.
    """

    def __init__(self, a_path: str, b_path: str, pattern: str | None = None):
        import sentencepiece

        self.a_path = a_path
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        with open(a_path, encoding="utf-8") as f:
            spec = json.load(f)
        letters, vocab = byte_of_letter(), spec["model"]["vocab"]
        special = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        self.a_bytes = [b""] * (1 + max([*vocab.values(), *special.values()]))
        for token, k in [*vocab.items(), *special.items()]:
            plain = token not in special and all(c in letters for c in token)
            self.a_bytes[k] = bytes(map(letters.__getitem__, token)) if plain else token.encode()
        self.ranked = self._ranks(spec, vocab, special, pattern)
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[1:-1], 16)]) if self.b.is_byte(k) else p.replace("▁", " ").encode()
                        for k, p in enumerate(pieces)]
        self.separable = not any(re.search("[^▁]▁", p) for p in pieces)
        of_bytes: dict[bytes, int] = {}
        for plain in (True, False):  # a piece of characters before a byte piece of the same bytes
            for k, text in enumerate(self.b_bytes):
                if self.b.is_byte(k) != plain and not self.b.is_control(k) and not self.b.is_unknown(k):
                    of_bytes.setdefault(text, k)
        self.same = [of_bytes.get(t, -1) for t in self.a_bytes]
        self.size_b = len(pieces)
        self.a_size, self.b_size = [len(t) for t in self.a_bytes], [len(t) for t in self.b_bytes]
        self.a_name, self.b_name = [str(k) for k in range(len(self.a_bytes))], [str(k) for k in range(len(pieces))]

    def _ranks(self, spec, vocab, special, pattern):
        """Encoder by ranks, or None where A is not of that kind."""
        cut = spec.get("pre_tokenizer") or {}
        merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in spec["model"].get("merges") or []]
        in_order = [vocab.get(m) for m in merged] == list(range(256, 256 + len(merged)))
        if pattern is None or spec.get("normalizer") or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") \
                or not cut.get("use_regex", True) or not in_order:
            return None
        import tiktoken

        ranks = {self.a_bytes[k]: k for token, k in vocab.items() if token not in special}
        return tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    @cached_property
    def a(self):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(self.a_path)
        tokenizer.encode_special_tokens = True  # their strings are plain text
        return tokenizer

    def encode(self, texts: list[str]):
        """Ids of (A of space + text, B of text) for each text."""
        if self.ranked:
            a = [self.ranked(" " + t) if len(t) < LONG else self.a.encode(" " + t, add_special_tokens=False).ids for t in texts]
        else:
            a = [x.ids for x in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        return zip(a, self.b.encode(texts, num_threads=1))


class Aligner:
    """Vocabularies and a bounded cache of aligned units; those met again outlive a clearing."""

    NOTHING = (0, 0, 0, 0, 1), "", b"", b""  # the last number: the bytes do not come back

    def __init__(self, a_path: str, b_path: str, pattern: str | None = None, cache_entries: int = 250_000):
        self.vocab, self.limit = Vocabularies(a_path, b_path, pattern), cache_entries
        self.index: dict[str, int] = {}
        self.spelt, self.regular, self.irregular = [], [], []
        self.stats, self.hits, self.held = np.zeros((0, 5), dtype=np.int64), np.zeros(0, dtype=np.int32), 0

    @classmethod
    def of_worker(cls, *paths) -> "Aligner":
        store = worker_store("alignment")
        if paths not in store:
            store[paths] = cls(*paths)
        return store[paths]

    def shrink(self) -> None:
        """Keep the units that several slices of texts held, half the limit at most."""
        keep = np.argsort(-self.hits, kind="stable")[:self.limit // 2]
        keep = np.sort(keep[self.hits[keep] > 1])
        names, at = list(self.index), keep.tolist()
        self.index = {names[k]: n for n, k in enumerate(at)}
        self.spelt, self.regular, self.irregular = ([x[k] for k in at] for x in (self.spelt, self.regular, self.irregular))
        self.stats, self.hits = self.stats[keep], np.ones(len(at), dtype=np.int32)
        self.held = sum(map(len, self.index))
        if self.held > HELD_CHARS // 2:  # long ones: start anew
            self.index, self.spelt, self.regular, self.irregular, self.held = {}, [], [], [], 0
            self.stats, self.hits = self.stats[:0], self.hits[:0]

    def aligned(self, text: str, a: list[int], b: list[int]):
        """(tokens of A and B, groups, links, 0), groups as text, A ids of identity groups, codes of the other links.

        Of two tokens the one that ends first gives way to the next one, which overlaps the other: each step is a link.
        """
        v, raw = self.vocab, b" " + text.encode()
        if b"".join([v.a_bytes[k] for k in a]) != raw or b"".join([v.b_bytes[k] for k in b]) != raw:
            return self.NOTHING
        la, lb, na, nb, same, size = v.a_size, v.b_size, v.a_name, v.b_name, v.same, v.size_b
        spelt, regular, irregular, i, j, end_a, end_b, n = [], [], [], 0, 0, 0, 0, len(a)
        while i < n:
            x, y = a[i], b[j]
            end_a, end_b = end_a + la[x], end_b + lb[y]
            if end_a == end_b:
                spelt.append(f"{na[x]}|{nb[y]}")
                if same[x] == y:
                    regular.append(x)
                else:
                    irregular.append(x * size + y)
            else:
                irregular.append(x * size + y)
                left, right = [na[x]], [nb[y]]
                while end_a != end_b:
                    if end_a < end_b:
                        i += 1
                        x = a[i]
                        end_a += la[x]
                        left.append(na[x])
                    else:
                        j += 1
                        y = b[j]
                        end_b += lb[y]
                        right.append(nb[y])
                    irregular.append(x * size + y)
                spelt.append(f"{','.join(left)}|{','.join(right)}")
            i, j = i + 1, j + 1
        return ((n, len(b), len(spelt), len(regular) + len(irregular), 0), ";".join(spelt), array("i", regular).tobytes(),
                array("q", irregular).tobytes())

    def prepare(self, cut: list[list[str]]) -> None:
        """Align every unit of these texts that is not in the cache."""
        if len(self.index) > self.limit or self.held > HELD_CHARS:
            self.shrink()
        need = {u for parts in cut for u in parts}
        new, numbers = list(need.difference(self.index)), []
        self.held += sum(map(len, new))
        for at in range(0, len(new), 10_000):
            some = new[at:at + 10_000]
            for text, (a, b) in zip(some, self.vocab.encode(some)):
                found, spelt, regular, irregular = self.aligned(text, a, b)
                self.index[text] = len(self.spelt)
                numbers.append(found), self.spelt.append(spelt), self.regular.append(regular), self.irregular.append(irregular)
        if new:
            self.stats = np.concatenate([self.stats, np.array(numbers, dtype=np.int64)])
            self.hits = np.concatenate([self.hits, np.zeros(len(new), dtype=np.int32)])
        self.hits[list(map(self.index.__getitem__, need))] += 1

    def documents(self, texts: list[str]):
        """Per text: (numbers, groups as text, A ids of identity groups, codes of other links), zeros if there are no tokens."""
        cut = [units(t) if t and self.vocab.separable else [] for t in texts]
        self.prepare(cut)
        for text, parts in zip(texts, cut):
            at = list(map(self.index.__getitem__, parts))
            numbers = self.stats[at].sum(axis=0) if at else None
            if numbers is not None and not numbers[4]:
                yield (numbers, ";".join(map(self.spelt.__getitem__, at)), b"".join(map(self.regular.__getitem__, at)),
                       b"".join(map(self.irregular.__getitem__, at)))
            else:  # a unit whose bytes changed: the text as a whole decides
                yield self.aligned(text, *next(self.vocab.encode([text]))) if text else self.NOTHING


class PairCounts:
    """Counts of id pairs of one task; `add` gives back what is over `most` distinct pairs."""

    def __init__(self, most: int = 1 << 18):
        self.most, self.waiting, self.size = most, [], 0
        self.codes, self.counts = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def add(self, codes: np.ndarray, counts: np.ndarray):
        self.waiting.append((codes, counts))
        self.size += len(codes)
        if self.size > 4 * self.most:
            self.merge()
            if len(self.codes) > self.most:
                yield self.take()

    def merge(self) -> None:
        every = [(self.codes, self.counts), *self.waiting]
        self.codes, place = np.unique(np.concatenate([c for c, _ in every]), return_inverse=True)
        self.counts = np.bincount(place, weights=np.concatenate([n for _, n in every]), minlength=len(self.codes)).astype(np.int64)
        self.waiting, self.size = [], 0

    def take(self):
        self.merge()
        out = self.codes, self.counts
        self.codes, self.counts = self.codes[:0], self.counts[:0]
        return out


_DOC = ("n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, groups string, "
        "regular binary, regular_n binary, irregular binary, irregular_n binary")


def _aligned(docs: DataFrame, paths: tuple, with_groups: bool, batch_chars: int) -> DataFrame:
    """Rows of documents (row, id, `_DOC`), and rows of a task's pair counts (codes, counts, same), written."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches):
        aligner = Aligner.of_worker(*paths)
        vector, pairs = np.zeros(len(aligner.vocab.same), dtype=np.int64), PairCounts()

        def count_rows(found, same):
            for codes, counts in found:
                yield _batch(schema, codes=[codes], counts=[counts], same=[same])

        for batch in batches:
            columns: dict[str, list] = {n: [] for n in names}
            flushed = []
            for part in slices(batch.column(2).to_pylist(), batch_chars):
                for numbers, spelt, regular, irregular in aligner.documents(part):
                    ids, n = np.unique(np.frombuffer(regular, dtype="<i4"), return_counts=True)
                    vector[ids] += n
                    codes, m = np.unique(np.frombuffer(irregular, dtype="<i8"), return_counts=True)
                    flushed += pairs.add(codes, m)
                    values = (*(int(x) for x in numbers[:4]),
                              hashlib.sha256(spelt.encode()).hexdigest() if spelt else "", spelt if with_groups else None,
                              ids.tobytes(), n.astype("<i8").tobytes(), codes.tobytes(), m.astype("<i8").tobytes())
                    for name, value in zip(names, values):
                        columns[name].append(value)
            yield _batch(schema, row=batch.column(0), id=batch.column(1), **columns)
            yield from count_rows(flushed, False)
        yield from count_rows([pairs.take()], False)
        ids = np.flatnonzero(vector)  # only ids that the map joins are ever counted here
        joined = np.array(aligner.vocab.same, dtype=np.int64)[ids]
        yield from count_rows([(ids * aligner.vocab.size_b + joined, vector[ids])], True)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    struct = StructType.fromDDL(f"row bigint, id {kind}, {_DOC}, codes array<bigint>, counts array<bigint>, same boolean")
    schema, names = to_arrow_schema(struct), [f.name for f in StructType.fromDDL(_DOC)]
    return materialize(docs.mapInArrow(run, struct))


def _batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """A batch of these columns, the others null."""
    size = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c := columns.get(f.name), pa.Array) else pa.array(c, f.type) if c is not None else pa.nulls(size, f.type)
         for f in schema], schema=schema)


def _ragged(blobs: list[bytes], kind: str):
    """(values of all blobs one after another, their ends)."""
    ends = np.cumsum([len(b) for b in blobs], dtype=np.int64) // np.dtype(kind).itemsize
    return np.frombuffer(b"".join(blobs), dtype=kind), ends


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return np.diff(total[np.concatenate([[0], ends])])


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
          with_groups: bool = False, known_pairs: int = 1 << 18, batch_chars: int = 1 << 22,
          pattern: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs); `pattern`: the pre-token pattern of A, see `Vocabularies`.

    documents: (id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256[, groups]), one row per row;
    pairs: (a, b, count, best), every id pair that a link holds, its links in the corpus, and whether no pair of
    the same B id has more.
    """
    docs = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("id"),
                       F.col(f"`{text_col}`").alias("text"))
    vocab = Vocabularies(a_path, b_path, pattern)
    size_b, same = vocab.size_b, np.array(vocab.same, dtype=np.int64)
    written = _aligned(docs, (a_path, b_path, pattern), with_groups, batch_chars)
    totals = materialize(written.where("codes is not null").select("same", F.explode(F.arrays_zip("codes", "counts")).alias("p"))
                         .groupBy(F.col("p.codes").alias("code")).agg(F.sum("p.counts").alias("count"), F.max("same").alias("same"))
                         .withColumn("b", F.col("code") % size_b))
    best = totals.groupBy("b").agg(F.max("count").alias("most"))  # a row for each id of B at most
    level = F.floor(F.log2("count")).cast("int")
    pairs = materialize(totals.join(F.broadcast(best), "b").select(
        "code", "count", "same", (F.col("count") == F.col("most")).alias("best"), level.alias("level")))
    held, cut = 0, 0
    for r in sorted(pairs.where("not same").groupBy("level").agg(F.count("*").alias("n")).collect(), reverse=True):
        if held + r["n"] > known_pairs:
            cut = r["level"] + 1
            break
        held += r["n"]
    known = pairs.where(F.col("same") | (F.col("level") >= cut)).select("code", "count", "best").toArrow()
    known = tuple(known.column(c).to_numpy() for c in ("code", "count", "best"))
    order = np.argsort(known[0])
    codes, counts, bests = (x[order] for x in known)
    mapped = np.arange(len(same)) * size_b + same
    at = np.minimum(np.searchsorted(codes, mapped), max(0, len(codes) - 1))
    hit = (same >= 0) & (codes[at] == mapped) if len(codes) else np.zeros(len(same), dtype=bool)
    of_map = (np.where(hit, counts[at], 0), hit & bests[at]) if len(codes) else (np.zeros(len(same), dtype=np.int64), hit)
    shared = docs.sparkSession.sparkContext.broadcast((codes, counts, bests.astype(bool), *of_map))

    def look_up(batches):
        codes, counts, bests, map_count, map_best = shared.value
        for batch in batches:
            columns = {name: batch.column(k).to_pylist() for k, name in enumerate(batch.schema.names) if "regular" in name}
            ids, ends = _ragged(columns["regular"], "<i4")
            n, _ = _ragged(columns["regular_n"], "<i8")
            n_best, count_sum = _sums(n * map_best[ids], ends), _sums(n * map_count[ids], ends)
            pair, ends = _ragged(columns["irregular"], "<i8")
            n, _ = _ragged(columns["irregular_n"], "<i8")
            at = np.minimum(np.searchsorted(codes, pair), max(0, len(codes) - 1))
            hit = codes[at] == pair if len(codes) else np.zeros(len(pair), dtype=bool)
            if len(codes):
                n_best += _sums(n * (hit & bests[at]), ends)
                count_sum += _sums(n * np.where(hit, counts[at], 0), ends)
            left = pa.array(np.concatenate([[0], np.cumsum(~hit)])[np.concatenate([[0], ends])], pa.int32())
            rest = [pa.ListArray.from_arrays(left, pa.array(x[~hit], pa.int64())) for x in (pair, n)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(8)), pa.array(n_best), pa.array(count_sum), *rest], names=out_names)

    first = written.where("codes is null").select(
        "row", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups", "regular", "regular_n", "irregular", "irregular_n")
    kind = written.schema["id"].dataType.simpleString()
    out_names = ["row", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups", "n_best", "count_sum", "rest", "rest_n"]
    summed = materialize(first.mapInArrow(look_up, (
        f"row bigint, id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, groups string, "
        "n_best bigint, count_sum bigint, rest array<bigint>, rest_n array<bigint>")))
    rare = (summed.where("size(rest) > 0").select("row", F.explode(F.arrays_zip("rest", "rest_n")).alias("p"))
            .select("row", F.col("p.rest").alias("code"), F.col("p.rest_n").alias("n")).join(pairs, "code")
            .groupBy(F.col("row").alias("rare_row")).agg(F.sum(F.col("n") * F.col("count")).alias("more"),
                                                         F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("more_best")))
    out = summed.join(rare, F.col("row") == F.col("rare_row"), "left")
    plus = lambda name, more: (F.col(name) + F.coalesce(more, F.lit(0))).alias(name)
    documents = out.select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", plus("n_best", "more_best"),
                           plus("count_sum", "more"), "groups_sha256", *["groups"] * with_groups)
    return documents, pairs.select(F.floor(F.col("code") / size_b).cast("int").alias("a"),
                                   (F.col("code") % size_b).cast("int").alias("b"), "count", "best")

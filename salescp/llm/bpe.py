"""Byte-level BPE encoding and decoding of whole texts.

Texts are cut into pre-tokens by the tokenizer's pattern; the pre-tokens of an
Arrow batch that the worker has not met before are encoded together by
`rank_queue`.  Every document is one row in and one row out: no shuffle, and a
worker holds one batch, a bounded cache and the vocabulary.

Defined results: a null text counts as empty (no ids, empty decoded text); a
null or repeated id is kept as it is, one result per input row; text that looks
like a special token is ordinary text; a text of any length, also one unbroken
pre-token, is encoded whole; an empty table gives no rows.  Columns other than the
id and the text are not read.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import worker_store
from .rank_queue import Vocabulary, encode_pieces


HELD_CHARS = 1 << 24  # characters of the keys that a cache may hold before it is emptied, besides its entries


class Encoder:
    """Pre-tokenizer, rank queue and a bounded cache of what this worker has encoded.

    The cache is keyed by space-separated chunks.  A chunk that does not begin
    with white space, with its leading space, is cut by the pattern in the same
    way wherever it stands; a text with any other chunk (runs of spaces) goes
    through the pattern as a whole.
    """

    def __init__(self, path: str, pattern: str, cache_entries: int = 500_000):
        self.vocab = Vocabulary.load(path)
        self.find = regex.compile(pattern).findall
        self.match = regex.compile(pattern).match
        self.limit, self.held, self.held_pieces = cache_entries, 0, 0
        self.pieces: dict[str, bytes] = {}   # pre-token -> ids
        self.chunks: dict[str, bytes | None] = {}  # chunk after a space -> ids, None: not separable
        self.layout: dict[str, bytes | None] = {}  # same -> (characters, ids) of each pre-token

    @classmethod
    def of_worker(cls, path: str, pattern: str) -> "Encoder":
        store = worker_store("bpe")
        if (path, pattern) not in store:
            store[path, pattern] = cls(path, pattern)
        return store[path, pattern]

    def learn(self, pieces) -> None:
        new = [p for p in set(pieces) if p not in self.pieces]
        self.held_pieces += sum(map(len, new))
        self.pieces.update(zip(new, encode_pieces(self.vocab, [p.encode() for p in new])))

    def prepare(self, texts: list[str], layout: bool = False) -> None:
        """Encode every pre-token of these texts that is not in the cache, for `ids` or (layout) for `leaves`."""
        if len(self.chunks) + len(self.layout) > self.limit or self.held > HELD_CHARS:
            self.chunks, self.layout, self.held = {}, {}, 0
        if len(self.pieces) > self.limit or self.held_pieces > HELD_CHARS:
            self.pieces, self.held_pieces = {}, 0
        need: set[str] = set()
        first: set[str] = set()
        for t in texts:
            parts = t.split(" ")
            first.add(parts[0])
            need.update(parts[1:])
        known = self.layout if layout else self.chunks
        need = need.difference(known)
        self.held += sum(map(len, need))
        cut = {c: self.find(" " + c) for c in need if c and not c[0].isspace()}
        pieces = {p for ps in cut.values() for p in ps}
        for c in first:
            pieces.update(self.find(c))
        self.learn(pieces)
        get = self._layout_of if layout else lambda ps: b"".join(map(self.pieces.__getitem__, ps))
        for c in need:
            known[c] = get(cut[c]) if c in cut else None

    def _whole(self, text: str) -> list[str]:
        pieces = self.find(text)
        self.learn(pieces)
        return pieces

    def _joined(self, text: str, known: dict, of_pieces) -> np.ndarray:
        """Cached bytes of a text's chunks, or of its pre-tokens if a chunk cannot be separated."""
        head, *rest = text.split(" ")
        try:
            body = b"".join(map(known.__getitem__, rest))
            if not head and rest:
                raise TypeError
            return np.frombuffer(of_pieces(self._whole(head)) + body, dtype="<i4")
        except (TypeError, KeyError):
            return np.frombuffer(of_pieces(self._whole(text)), dtype="<i4")

    def ids(self, text: str) -> np.ndarray:
        """Ids of one whole text (quick after `prepare`)."""
        return self._joined(text, self.chunks, lambda ps: b"".join(map(self.pieces.__getitem__, ps)))

    def leaves(self, text: str) -> np.ndarray:
        """(characters, ids) of each pre-token of one whole text (quick after `prepare(layout=True)`)."""
        return self._joined(text, self.layout, self._layout_of).reshape(-1, 2)

    def _layout_of(self, pieces: list[str]) -> bytes:
        get = self.pieces
        return struct.pack(f"<{2 * len(pieces)}i", *(x for p in pieces for x in (len(p), len(get[p]) >> 2)))

    def count(self, pieces: list[str]) -> list[int]:
        self.learn(pieces)
        return [len(self.pieces[p]) // 4 for p in pieces]

    def decode(self, ids) -> bytes:
        return self.vocab.decode(ids)


def ids_column(encoder: Encoder, ids: np.ndarray) -> dict:
    return {"ids": ids, "decoded": encoder.decode(ids)}


def digest_columns(encoder: Encoder, ids: np.ndarray) -> dict:
    """What the registered query reports of a document's ids and their decoding."""
    return {"n_tokens": len(ids),
            "ids_sha256": hashlib.sha256(" ".join(map(str, ids.tolist())).encode()).hexdigest(),
            "decoded_sha256": hashlib.sha256(encoder.decode(ids)).hexdigest()}


def encode_decode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                  finish: Callable[[Encoder, np.ndarray], dict] = ids_column,
                  schema: str = "ids array<int>, decoded binary", batch_chars: int = 1 << 25) -> DataFrame:
    """Encode each text and decode the ids again; one row per input row.

    `finish(encoder, ids)` gives the columns of `schema` for one document (by
    default the ids and the decoded bytes).  The cache is filled for at most
    `batch_chars` characters (or one longer text) at a time.
    """
    docs = docs.select(docs[id_col].alias(id_col), docs[text_col].alias("text"))

    def run(batches):
        encoder = Encoder.of_worker(path, pattern)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            rows = []
            for part in slices(texts, batch_chars):
                encoder.prepare(part)
                rows += [finish(encoder, encoder.ids(t)) for t in part]
            yield pa.RecordBatch.from_arrays(
                [keys, *(pa.array([r[f.name] for r in rows], type=f.type) for f in fields)],
                names=[id_col, *(f.name for f in fields)])

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    fields = list(to_arrow_schema(StructType.fromDDL(schema)))
    return docs.mapInArrow(run, f"{id_col} {docs.schema[0].dataType.simpleString()}, {schema}")


def slices(texts: list[str | None], limit: int):
    """The texts in order (null: empty), in lists of about `limit` characters."""
    part, size = [], 0
    for t in texts:
        t = t or ""
        if part and size + len(t) > limit:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t)
    if part:
        yield part

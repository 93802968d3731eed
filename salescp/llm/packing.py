"""Best-fit packing of tokenised documents into sequences of a fixed length.

The plan is made over the histogram of piece lengths, never over documents:
lengths from the longest down, each length's whole count into the open
sequences with the least room that still fits, else into new ones.  Sequences
of equal room are kept as ranges of numbers, so one step places up to a whole
length's count, and a plan row says: these ranks of this length go, `per` to a
sequence, to the sequences from `first` on, at this offset.  Documents then take
their slots by their rank within their length.

Texts are cut on the bytes of their Arrow column, all rows of a slice at once; each
distinct part of a slice is looked up, or tokenised, once.

Scale.  The driver sees one count per length (at most `limit` of them) and
makes the plan rows from them.  The rank within a length is a count over
(length, bucket) plus a rank inside the bucket, so a length that a third of all
rows share is spread over `buckets` windows.  The plan is broadcast only when
it has at most `MAX_BROADCAST_PLAN` rows; else it is joined by shuffle.

Defined results: a null or empty text has just the closing id; null ids and
repeated rows are packed like any other row (a place per row); a text of any
length is tokenised whole and cut only into pieces; an empty table gives no rows.
Columns other than the id and the text are not read.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescp.session import materialize

from .bpe import HELD_CHARS
from .common import let_go, slices_of_rows, worker_store

CACHES = 1_000_000, 250_000  # parts and chunks that are not cut: at most about 250 MB of a worker
MAX_BROADCAST_PLAN = 200_000  # rows of 6 numbers: about 10 MB

# Chunks (between spaces) in which lower-casing and cutting at letters, digits and other signs need no context.
_PLAIN = re.compile("[!-&(-;=-~À-ÖØ-öø-ÿ]+")

# What a byte of UTF-8 is: every plain sign beyond ASCII is 0xC3 and one more byte, and a letter.
_GAP, _LETTER, _DIGIT, _SIGN, _OTHER = range(5)
_KIND = np.full(256, _OTHER, dtype=np.uint8)
_KIND[[ord("\n"), ord(" ")]] = _GAP
_KIND[ord("!"):ord("~") + 1] = _SIGN
_KIND[[ord("'"), ord("<")]] = _OTHER
_KIND[ord("0"):ord("9") + 1] = _DIGIT
_KIND[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), 0xC3, *range(0x80, 0xC0)]] = _LETTER
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def cut_parts(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(parts of these texts in order, the number of parts before each text and in all).

    A plain chunk is cut, in lower case, into runs of letters, single digits and
    runs of other signs; any other chunk is one part, as it stands.
    """
    texts = texts.fill_null("").cast(pa.large_string())
    edges = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[edges[0]:edges[-1]]
    edges = edges - edges[0]
    if not len(data):
        return pa.array([], pa.large_string()), np.zeros(len(texts) + 1, np.int64)
    kind = _KIND[data]
    two = np.flatnonzero(data == 0xC3)
    second = data[np.minimum(two + 1, len(data) - 1)]
    kind[two[(second == 0x97) | (second == 0xB7)]] = _OTHER  # the signs for times and divided by
    lower = _LOWER[data]
    lower[two[second < 0x9F] + 1] += 0x20
    opens = np.zeros(len(data) + 1, dtype=bool)
    opens[edges] = True
    starts = opens[:-1] | (kind == _DIGIT)
    starts[1:] |= kind[1:] != kind[:-1]
    rest = np.flatnonzero(kind == _OTHER)
    if len(rest):
        filled = kind != _GAP
        begin, end = opens[:-1].copy(), opens[1:].copy()
        begin[1:] |= ~filled[:-1]
        end[:-1] |= ~filled[1:]
        begin, end = np.flatnonzero(begin & filled), np.flatnonzero(end & filled) + 1
        whole = np.unique(np.searchsorted(begin, rest, side="right") - 1)
        step = np.zeros(len(data) + 1, dtype=np.int8)
        step[begin[whole]] += 1
        step[end[whole]] -= 1
        inside = np.cumsum(step[:-1], dtype=np.int8).view(bool)
        starts[inside] = False
        starts[begin[whole]] = True
        lower[inside] = data[inside]
    kept = kind != _GAP
    starts &= kept
    at = np.flatnonzero(starts)
    lower = lower[kept]
    bounds = np.append(np.flatnonzero(starts[kept]), len(lower))
    parts = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(bounds), pa.py_buffer(lower))
    return parts, np.searchsorted(at, edges)


class CachedTokenizer:
    """A `tokenizers` tokenizer whose white space separates, with bounded caches of the parts and of the
    chunks that are not cut."""

    def __init__(self, path: str, part_entries: int = CACHES[0], chunk_entries: int = CACHES[1]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocab = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocab.values(), default=0) + 1, dtype=bool)
        self.ends_word[[i for token, i in vocab.items() if suffix and token.endswith(suffix)]] = True
        self.limits, self.held, self.held_parts = (part_entries, chunk_entries), 0, 0
        self.chunks: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    @classmethod
    def of_worker(cls, path: str, caches: tuple[int, int]) -> "CachedTokenizer":
        store = worker_store("tokenizers")
        if (path, caches) not in store:
            store[path, caches] = cls(path, *caches)
        return store[path, caches]

    def _known(self, parts: list[str]) -> list[bytes]:
        """Ids of each of these parts; those that are not in the caches are tokenised."""
        if len(self.chunks) > self.limits[1] or self.held > HELD_CHARS:
            self.chunks, self.held = {}, 0
        if len(self.parts) > self.limits[0] or self.held_parts > HELD_CHARS:
            self.parts, self.held_parts = {}, 0
        found = list(map(self.parts.get, parts))
        for k in [k for k, ids in enumerate(found) if ids is None]:
            found[k] = self.chunks.get(parts[k])
        missing = [k for k, ids in enumerate(found) if ids is None]
        for at in range(0, len(missing), 10_000):
            some = missing[at:at + 10_000]
            plain = [k for k in some if _PLAIN.fullmatch(parts[k])]
            for k, ids in zip(plain, self._words([parts[k] for k in plain])):
                found[k] = self.parts[parts[k]] = ids
                self.held_parts += len(parts[k])
            other = sorted(set(some).difference(plain))
            for k, ids in zip(other, self._each([parts[k] for k in other])):
                found[k] = self.chunks[parts[k]] = ids
                self.held += len(parts[k])
        return found

    def _each(self, parts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]

    def _words(self, parts: list[str], together: int = 200) -> list[bytes]:
        """Ids of plain parts, each of which is one word to the tokenizer: many go as one text, and a token that
        ends a word tells them apart."""
        lists = [parts[k:k + together] for k in range(0, len(parts), together)]
        out: list[bytes] = []
        for some, e in zip(lists, self.tokenizer.encode_batch_fast([" ".join(x) for x in lists], add_special_tokens=False)):
            ids = np.array(e.ids, dtype="<u4")
            ends = 4 * np.flatnonzero(self.ends_word[ids]) + 4
            raw = ids.tobytes()
            if len(ends) != len(some) or ends[-1] != len(raw):  # a tokenizer without such tokens
                out += self._each(some)
                continue
            starts = [0, *ends.tolist()]
            out += [raw[lo:hi] for lo, hi in zip(starts, starts[1:])]
        return out

    def encode(self, texts: pa.Array) -> tuple[memoryview, np.ndarray]:
        """(little-endian unsigned 32-bit ids of all texts, the byte at which each begins and the last ends)."""
        parts, first = cut_parts(texts)
        if not len(parts):
            return memoryview(b""), first
        coded = parts.dictionary_encode()
        ids = pa.array(self._known(coded.dictionary.to_pylist()), pa.large_binary()).take(coded.indices)
        edges = np.frombuffer(ids.buffers()[1], np.int64)[ids.offset:ids.offset + len(ids) + 1]
        return memoryview(ids.buffers()[2] or b""), edges[first]

    def prepare(self, texts: list[str]) -> None:
        """Fill the caches with what these texts hold."""
        self.encode(pa.array(texts, pa.string()))

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of a whole text (quick after `prepare`)."""
        return bytes(self.encode(pa.array([text], pa.string()))[0])


def tokenise(docs: DataFrame, path: str, limit: int = 4096, end_id: int = 1, with_ids: bool = False,
             id_col: str = "doc_id", text_col: str = "text", batch_chars: int = 1 << 22,
             caches: tuple[int, int] = CACHES) -> DataFrame:
    """Pieces of at most `limit` ids: (id, piece, start, length, ids_crc32[, ids]).

    `caches`: parts and chunks that a worker may keep; fewer cost time, more cost memory.
    """
    docs = docs.select(docs[id_col].alias(id_col), docs[text_col].alias("text"))
    kind = docs.schema[0].dataType.simpleString()
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        let_go()  # of what earlier operators' tasks have left
        tokenizer = CachedTokenizer.of_worker(path, caches)
        for whole in batches:
            for batch in slices_of_rows(whole, 1, batch_chars):  # the parts of one slice at a time are held
                source, number, start, length, crc, ids = [], [], [], [], [], []
                held, edges = tokenizer.encode(batch.column(1))
                for at in range(batch.num_rows):
                    raw = bytes(held[edges[at]:edges[at + 1]]) + end
                    for k, b in enumerate(range(0, len(raw), 4 * limit)):
                        piece = raw[b:b + 4 * limit]
                        source.append(at), number.append(k), start.append(b // 4)
                        length.append(len(piece) // 4), crc.append(zlib.crc32(piece))
                        if with_ids:
                            ids.append(np.frombuffer(piece, dtype="<u4").astype(np.int32))
                arrays = [batch.column(0).take(pa.array(source, pa.int64())), pa.array(number, pa.int32()),
                          *(pa.array(x, pa.int64()) for x in (start, length, crc))]
                if with_ids:
                    arrays.append(pa.array(ids, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = f"{id_col} {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    names = [id_col, "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    return docs.mapInArrow(run, schema)


def plan(histogram: dict[int, int], limit: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit, longest first, over counts: rows (length, rank, count, per, first, offset).

    The pieces of `length` with ranks rank .. rank + count - 1 go, `per` to a
    sequence, to the sequences first, first + 1, ... one behind the other from `offset`.
    """
    room: dict[int, list[tuple[int, int]]] = {}  # room left -> ranges (first sequence, how many)
    rooms: list[int] = []
    rows, opened = [], 0

    def leave(space, first, n):
        if space > 0 and n > 0:
            if space not in room:
                room[space] = []
                insort(rooms, space)
            room[space].append((first, n))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        if length > limit:
            raise ValueError("a piece is longer than a sequence")
        while left > 0:
            k = bisect_left(rooms, length)
            if k < len(rooms):
                space = rooms[k]
                first, n = room[space].pop()
                if not room[space]:
                    del room[space], rooms[k]
            else:
                space, first, n = limit, opened, -(-left // (limit // length))
                opened += n
            per = space // length
            used = min(n, -(-left // per))
            leave(space, first + used, n - used)
            count = min(left, used * per)
            rows.append((length, rank, count, per, first, limit - space))
            full, rest = divmod(count, per)
            leave(space - per * length, first, full)
            if rest:
                leave(space - rest * length, first + full, 1)
            rank += count
            left -= count
    return rows


def pack(pieces: DataFrame, limit: int = 4096, id_col: str = "doc_id", buckets: int = 256) -> DataFrame:
    """`pieces` with `sequence_id` and `offset`; its `length` must be between 1 and `limit`.

    `pieces` is read three times; pass a written table.
    """
    spark = pieces.sparkSession
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    rows = plan(histogram, limit)
    slots = spark.createDataFrame(rows, "_l long, _rank long, _n long, _per long, _first long, _offset long")
    if len(rows) <= MAX_BROADCAST_PLAN:
        slots = F.broadcast(slots)
    spread = pieces.withColumn("_bucket", F.pmod(F.xxhash64(id_col, "piece"), F.lit(buckets)).cast("int"))
    before = (spread.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
              .select("length", "_bucket", (F.sum("_n").over(Window.partitionBy("length").orderBy("_bucket")) - F.col("_n"))
                      .alias("_before")))
    ranked = (spread.withColumn("_k", F.row_number().over(
                  Window.partitionBy("length", "_bucket").orderBy(id_col, "piece")) - 1)
              .join(before, ["length", "_bucket"]).withColumn("_k", F.col("_k") + F.col("_before")))
    placed = ranked.join(slots, (F.col("length") == F.col("_l")) & (F.col("_k") >= F.col("_rank"))
                         & (F.col("_k") < F.col("_rank") + F.col("_n")))
    return placed.selectExpr(*[f"`{c}`" for c in pieces.columns],
                             "cast(_first + (_k - _rank) div _per as bigint) as sequence_id",
                             "cast(_offset + pmod(_k - _rank, _per) * length as bigint) as offset")


def pack_documents(docs: DataFrame, path: str, limit: int = 4096, end_id: int = 1, with_ids: bool = False,
                   id_col: str = "doc_id", text_col: str = "text", caches: tuple[int, int] = CACHES) -> DataFrame:
    """Tokenise, cut what is longer than a sequence, and pack; one row per piece."""
    return pack(materialize(tokenise(docs, path, limit, end_id, with_ids, id_col, text_col, caches=caches)), limit, id_col)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of a packing with ids; a sequence has at most `limit` ids."""
    return packed.groupBy("sequence_id").agg(F.expr(
        "flatten(transform(array_sort(collect_list(struct(offset, ids))), x -> x.ids))").alias("ids"))

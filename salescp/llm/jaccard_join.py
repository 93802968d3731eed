"""N-gram Jaccard join: T-occurrence search with DivideSkip.

Two documents link when their sets of word shingles overlap in at least `num` /
`den` of their union.  A document of n shingles can only link with one that
occurs in its inverted lists T times or more, T = ceil(n * num / den); so a
partner must occur in one of its n - T + 1 shortest lists, and the T - 1 long
ones are only probed.

1. Sets: every text's shingle hashes (64 bits), their number and a 64-bit key
   of the set; equal sets are one class from here on.
2. List lengths: all shingles of all documents are counted, as sorted, packed
   fingerprints.  The (at most `known_lengths`) longest lists' fingerprints and
   rounded lengths are broadcast, a table of bounded size; so are rounded counts of
   all words (in 2**18 slots by hash), by whose sum the other lists' lengths are
   estimated: a shingle of rare words has a short list.  Lengths only order the
   lists; every order gives the same links.
3. Candidates: each class posts its n - T + 1 shortest lists and T // 12 more, so
   that linking sets meet in 1 + T // 12 of them at least (T of the smaller).  The
   lists' true lengths are known once they are together: lists of one class go, and
   each class leaves as many of its longest as both sides of a link can spare, half
   of T // 12.  So a passage or a chance meeting joins no two documents, and the long
   documents of a large table are not chained into one group.  Within a list, sorted
   by set size, neighbours within the size bound are chained: a number of edges
   below the list's length, yet every pair that can link is connected.
4. Search: each connected set of candidates is one group, in blocks of about
   `block` shingles; groups of several blocks are searched for each pair of blocks
   whose sizes can link.  Inside, DivideSkip: the short lists are merged with a
   heap, entries that already belong to the document's component are left out,
   and the long lists are probed by binary search for what is left.  Only texts
   of candidates are shuffled: a bitmap of their ids, of bounded size, is
   broadcast and drops nearly all others first.
5. Components over the links found (a spanning set of them per group), then over
   classes; class members take over the component.

No pair of a group is emitted, exact copies never meet, and nothing is capped.
Shuffle files go as each step ends, written tables once the components are known.

Defined results: a text without a word (null, empty, white space) has an empty
set and links with nothing; fewer words than `words` make one shingle; rows
with a null id get their set size and a null component and link with nothing;
rows that repeat an id are documents of their own with that id; texts of any
length are read whole, in pieces that end at a space; an empty table gives no rows.
Columns other than id and text are not read.
"""

from __future__ import annotations

import heapq
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescp.session import drop_materialized, materialize, scratch, shuffles_go

from .common import components, let_go

_CLEAN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz     ")
_CHUNK = 1 << 20
SPARE = 12  # a class posts a list more for so many of its required overlap
LONG = 4096  # lists of more classes count as this long
MOST_LARGE = 1_000_000  # classes that are dealt by id, at most


def _mix(x):
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sets of word-shingle hashes, by array operations over the bytes of a text."""

    BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64

    def __init__(self, words: int = 5):
        self.words = words
        self.byte = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
        self.power = self.inverse = np.ones(1, dtype=np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.power) < n:
            size = 1 << (n - 1).bit_length()
            for name, base in (("power", self.BASE), ("inverse", pow(self.BASE, -1, 1 << 64))):
                steps = np.full(size, base, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def _words(self, data: bytes) -> np.ndarray:
        """Hash of each word: its bytes as a polynomial, moved to place 0; long words by blake2b."""
        a = np.frombuffer(data, dtype=np.uint8)
        space = np.concatenate(([True], a == 32, [True]))
        edges = np.flatnonzero(space[1:] != space[:-1])
        starts, ends = edges[::2], edges[1::2]
        if not len(starts):
            return np.zeros(0, dtype=np.uint64)
        self._powers(len(a) + 1)
        sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(self.byte[a] * self.power[:len(a)], dtype=np.uint64)))
        out = _mix((sums[ends] - sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))
        for k in np.flatnonzero(ends - starts > 256).tolist():
            out[k] = int.from_bytes(blake2b(data[starts[k]:ends[k]], digest_size=8).digest(), "little")
        return out

    def of_words(self, text: str | None) -> np.ndarray:
        """Hash of each word of the whole text."""
        data = (text or "").encode().translate(_CLEAN)
        parts, at = [], 0
        while at < len(data):  # very long texts in pieces that end at a space
            end = len(data) if len(data) - at <= _CHUNK else data.find(b" ", at + _CHUNK)
            end = len(data) if end < 0 else end
            parts.append(self._words(data[at:end]))
            at = end
        return np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)

    def _each(self, h: np.ndarray) -> np.ndarray:
        """Hash of the shingle at each place, of the hashes of one word or more."""
        w = min(self.words, len(h))
        s = h[:len(h) - w + 1].copy()
        for k in range(1, w):
            s = _mix(s) + h[k:len(h) - w + 1 + k]
        return _mix(s + np.uint64(w))

    def of_hashes(self, h: np.ndarray) -> np.ndarray:
        if not len(h):
            return h
        s = np.sort(self._each(h))  # np.unique hashes first, which takes longer
        return s[np.concatenate(([True], s[1:] != s[:-1]))]

    def __call__(self, text: str | None) -> np.ndarray:
        """Sorted distinct 64-bit hashes of the shingles of the whole text."""
        return self.of_hashes(self.of_words(text))

    def weighed(self, h: np.ndarray, levels: np.ndarray):
        """The same of one word or more, and for each shingle the sum of its words' levels."""
        s = self._each(h)
        order = np.argsort(s)
        s = s[order]
        once = np.concatenate(([True], s[1:] != s[:-1]))
        w = min(self.words, len(h))
        up_to = np.concatenate(([0], np.cumsum(levels[_slot(h)], dtype=np.int64)))
        return s[once], (up_to[w:] - up_to[:-w])[order[once]]


def set_key(shingles: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).astype(np.int64))


def required(n: int, num: int, den: int) -> int:
    """Least overlap of a set of n with any set it links with."""
    return -(-n * num // den)


def _sets(docs: DataFrame, words: int, emit, schema: str) -> DataFrame:
    """`emit(shingler, batch)` over (id, text) batches."""

    def run(batches):
        shingler = Shingler(words)
        for batch in batches:
            yield from emit(shingler, batch)
        let_go()

    return docs.mapInArrow(run, schema)


# List lengths: fingerprints are the top FINGER bits of a shingle's hash, dealt to 2**b buckets by their top b bits.
FINGER = 40
LEVELS = 256
# Word counts: 2**SLOTS slots by the top bits of a word's hash, added up in ranges of 2**RANGE slots.
SLOTS = 18
RANGE = 12


def _level(counts):
    return np.minimum(LEVELS - 1, np.floor(4 * np.log2(counts))).astype(np.uint8)


def _slot(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(64 - SLOTS)).astype(np.int64)


def _word_levels(counts: np.ndarray) -> np.ndarray:
    return np.minimum(LEVELS - 1, np.floor(8 * np.log2(counts + 1.0))).astype(np.uint8)


def _pack(values: np.ndarray) -> bytes:
    """Sorted numbers as differences, byte by byte of the needed width."""
    gaps = np.diff(values, prepend=np.uint64(0))
    width = max(1, (int(gaps.max()).bit_length() + 7) // 8)
    return bytes([width]) + np.ascontiguousarray(gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _unpack(blob: bytes) -> np.ndarray:
    width = blob[0]
    raw = np.frombuffer(blob, dtype=np.uint8, offset=1).reshape(-1, width)
    out = np.zeros((len(raw), 8), dtype=np.uint8)
    out[:, :width] = raw
    return np.cumsum(out.view("<u8")[:, 0], dtype=np.uint64)


def _count_batch(sets: list[np.ndarray], bits: int):
    """By bucket: (bucket, distinct fingerprints, those that repeat, how often more) of a batch's sets, packed."""
    f, n = np.unique(np.concatenate(sets) >> np.uint64(64 - FINGER), return_counts=True)
    bucket = (f >> np.uint64(FINGER - bits)).astype(np.int64)
    low = f & np.uint64((1 << (FINGER - bits)) - 1)
    cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
    for a, b in zip(cuts[:-1], cuts[1:]):
        again = np.flatnonzero(n[a:b] > 1) + a
        yield (int(bucket[a]), _pack(low[a:b]), _pack(low[again]) if len(again) else b"",
               (n[again] - 1).astype("<u4").tobytes())


def _add_batches(blobs, again, times):
    """(fingerprints, counts) of one bucket over all batches."""
    f, n = np.unique(np.concatenate([_unpack(b) for b in blobs]), return_counts=True)
    for values, more in zip(again, times):
        if len(values):
            n[np.searchsorted(f, _unpack(values))] += np.frombuffer(more, dtype="<u4")
    return f, n


def list_lengths(docs: DataFrame, words: int, total: int, known: int, per_bucket: int = 1 << 20):
    """(fingerprints, levels) of at most `known` longest inverted lists over all documents; levels of word slots.

    Equal sets that meet in one batch count once.  `total` is the number of postings.
    """
    bits = min(24, max(4, (total // per_bucket).bit_length()))

    def rows(columns):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.binary(), pa.binary(), pa.binary()))],
            names=["bucket", "blob", "again", "times"])

    def emit(batches):
        shingler, used = Shingler(words), np.zeros(1 << SLOTS, dtype=np.int64)
        for batch in batches:
            seen, sets, slots = set(), [], []
            for text in batch.column(1).to_pylist():
                h = shingler.of_words(text)
                s = shingler.of_hashes(h)
                key = s.tobytes() if len(s) < 4 else set_key(s)
                if len(s) and key not in seen:
                    seen.add(key)
                    sets.append(s)
                    slots.append(_slot(h))
            if sets:
                used += np.bincount(np.concatenate(slots), minlength=1 << SLOTS)
                yield rows(zip(*_count_batch(sets, bits)))
        if used.any():  # a task's word counts, under the numbers below 0
            ranges = used.astype("<i8").reshape(-1, 1 << RANGE)
            yield rows(zip(*[(-1 - k, x.tobytes(), b"", b"") for k, x in enumerate(ranges)]))
        let_go()

    def count(key, frame):
        if key[0] < 0:
            total = sum(np.frombuffer(x, dtype="<i8") for x in frame["blob"])
            return pd.DataFrame([(int(key[0]), _word_levels(total).tobytes(), 0)], columns=["level", "fingers", "n"])
        # the bucket's fingerprints that occur again, with the level of their count
        f, n = _add_batches(frame["blob"], frame["again"], frame["times"])
        f, level = f[n > 1] + np.uint64(int(key[0]) << (FINGER - bits)), _level(n[n > 1])
        out = [(int(x), f[level == x].astype("<u8").tobytes(), int((level == x).sum())) for x in np.unique(level)]
        return pd.DataFrame(out, columns=["level", "fingers", "n"])

    packed = docs.mapInArrow(emit, "bucket bigint, blob binary, again binary, times binary")
    counted = materialize(packed.groupBy("bucket").applyInPandas(count, "level int, fingers binary, n bigint"))
    used = {r["level"]: bytes(r["fingers"]) for r in counted.where("level < 0").collect()}
    used = np.frombuffer(b"".join(used.get(-1 - k, bytes(1 << RANGE)) for k in range(1 << (SLOTS - RANGE))), dtype=np.uint8)
    least, room = LEVELS, known
    for r in counted.where("level >= 0").groupBy("level").agg(F.sum("n").alias("n")).orderBy(F.desc("level")).collect():
        if r["n"] > room:
            break
        least, room = r["level"], room - r["n"]
    rows = [(r["level"], np.frombuffer(bytes(r["fingers"]), dtype="<u8"))
            for r in counted.where(F.col("level") >= least).select("level", "fingers").toLocalIterator()]
    if not rows:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint8), used
    f = np.concatenate([x for _, x in rows])
    level = np.repeat(np.array([x for x, _ in rows], dtype=np.uint8), [len(x) for _, x in rows])
    order = np.argsort(f)
    return f[order], level[order], used


def _least(values: np.ndarray, k: int) -> np.ndarray:
    """Places of the `k` least values; of equal ones the first."""
    if k >= len(values):
        return np.arange(len(values))
    last = np.partition(values, k - 1)[k - 1]
    below = np.flatnonzero(values < last)
    return np.concatenate((below, np.flatnonzero(values == last)[:k - len(below)]))


def postings(docs: DataFrame, words: int, num: int, den: int, lengths) -> DataFrame:
    """(h, c, n): shingle, class and its size, for each class's shortest lists; equal sets of one batch post once."""
    shared = docs.sparkSession.sparkContext.broadcast(lengths)

    def emit(shingler, batch):
        fingers, levels, used = shared.value
        seen, out = set(), []
        for text in batch.column(1).to_pylist():
            h = shingler.of_words(text)
            if not len(h):
                continue
            s, guess = shingler.weighed(h, used)
            n = len(s)
            key = set_key(s)
            if key in seen:
                continue
            seen.add(key)
            level = np.zeros(n, dtype=np.int64)
            if len(fingers):
                f = s >> np.uint64(64 - FINGER)
                at = np.minimum(np.searchsorted(fingers, f), len(fingers) - 1)
                level = np.where(fingers[at] == f, levels[at], 0).astype(np.int64)
            level = (level << 32) + guess  # unknown lists first, of rare words before others
            t = required(n, num, den)
            short = s[_least(level, n - t + 1 + t // SPARE)]
            out.append((short, key, n))
        if out:
            sizes = [len(s) for s, _, _ in out]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([s for s, _, _ in out]).astype(np.int64)),
                 pa.array(np.repeat(np.array([k for _, k, _ in out], dtype=np.int64), sizes)),
                 pa.array(np.repeat(np.array([n for _, _, n in out], dtype=np.int32), sizes))], names=["h", "c", "n"])

    return _sets(docs, words, emit, "h bigint, c bigint, n int")


def _met(batches):
    """(h, c, n, m) of postings sorted by (h, n, c), each once: m classes in the list, two or more."""

    def lists(h, c, n, long):
        ends = np.flatnonzero(np.concatenate((h[1:] != h[:-1], [True]))) + 1
        size = np.diff(ends, prepend=0)
        m = np.minimum(size, LONG).astype(np.int32)
        if h[0] == long:
            m[0] = LONG
        m = np.repeat(m, size)
        return pa.RecordBatch.from_arrays([pa.array(x[m > 1]) for x in (h, c, n, m)], names=["h", "c", "n", "m"])

    # the last list is held, as it may go on; of one that has more than LONG classes, a single row
    held, long = [np.zeros(0, dtype=t) for t in (np.int64, np.int64, np.int32)], None
    for batch in batches:
        h, c, n = (np.concatenate((x, y.to_numpy(zero_copy_only=False))) for x, y in zip(held, batch.columns))
        if not len(h):
            continue
        once = np.concatenate(([True], (h[1:] != h[:-1]) | (c[1:] != c[:-1])))
        h, c, n = h[once], c[once], n[once]
        last, went_on = int(np.searchsorted(h, h[-1])), long
        if h[-1] == long or len(h) - last > LONG:
            last, long = len(h) - 1, h[-1]
        if last:
            yield lists(h[:last], c[:last], n[:last], went_on)
        held = [x[last:] for x in (h, c, n)]
    if len(held[0]):
        yield lists(*held, long)
    let_go()


def chains(posted: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): neighbours in the lists of `posted` (h, c, n), once each class has left out its longest lists."""
    met = materialize(posted.repartition("h").sortWithinPartitions("h", "n", "c")
                      .mapInArrow(_met, "h bigint, c bigint, n int, m int"))
    least = F.expr(f"((n * {num}L + {den - 1}) div {den} * {num} + {den - 1}) div {den}")  # required(required(n))
    rank = F.row_number().over(Window.partitionBy("c").orderBy(F.desc("m"), "h"))
    kept = met.withColumn("spare", F.floor(least / (2 * SPARE))).withColumn("rank", rank).where("rank > spare")
    w = Window.partitionBy("h").orderBy("n", "c")
    return (kept.select("c", "n", F.lag("c").over(w).alias("d"), F.lag("n").over(w).alias("k"))
            .where((F.col("c") != F.col("d")) & (F.col("k") * den >= F.col("n") * num))
            .select(F.least("c", "d").alias("a"), F.greatest("c", "d").alias("b")))


def divide_skip(sets: list[np.ndarray], num: int, den: int, split: int = 0) -> list[tuple[int, int]]:
    """Links (x, y) that connect every pair of linking sets; `sets` ascend in size.

    With `split`, only sets before it are searched, among those from it on.
    Pairs that earlier links connect already are left out.
    """
    m = len(sets)
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(m), sizes)
    distinct, ids, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    members = owner[np.argsort(ids, kind="stable")]
    begin = np.concatenate(([0], np.cumsum(count)))
    at = np.concatenate(([0], np.cumsum(sizes)))
    own = [ids[at[k]:at[k + 1]] for k in range(m)]
    root = np.arange(m)
    links, parts = [], m
    for x in range(split or m):
        if parts == 1:
            break
        n = int(sizes[x])
        least = -(-2 * n * num // (num + den))  # the smallest overlap with a set no smaller than this
        mine = own[x]
        order = np.argsort(count[mine], kind="stable")
        short, long = mine[order[:n - least + 1]], np.sort(mine[order[n - least + 1:]])
        lists = []
        for s in short[count[mine][order[:n - least + 1]] > 1].tolist():
            entries = members[begin[s]:begin[s + 1]]
            entries = entries[np.searchsorted(entries, max(x, split - 1), side="right"):]
            entries = entries[root[entries] != root[x]]
            if len(entries):
                lists.append(entries.tolist())
        if not lists:
            continue
        merged, y, seen = heapq.merge(*lists), -1, 0
        for entry in [*merged, -2]:
            if entry == y:
                seen += 1
                continue
            if y >= 0 and root[y] != root[x]:
                k = int(sizes[y])
                need = -(-(n + k) * num // (num + den))
                if n * den >= k * num and seen + len(long) >= need:
                    theirs = own[y]  # probe the long lists by binary search
                    place = np.minimum(np.searchsorted(theirs, long), k - 1)
                    if seen + int((theirs[place] == long).sum()) >= need:
                        links.append((x, y))
                        root[root == root[y]] = root[x]
                        parts -= 1
            y, seen = entry, 1
    return links


def near_duplicates(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id",
                    text_col: str = "text", known_lengths: int = 1_000_000, block: int = 1 << 20,
                    deal: int = 1 << 14) -> DataFrame:
    """(id, n_shingles, component_id, text_hash): one row per document, components over all links.

    text_hash (xxhash64 of the text) tells rows that repeat an id apart.
    """
    docs = docs.select(docs[id_col].alias("_id"), docs[text_col].alias("_text"))
    with shuffles_go(docs.sparkSession):
        return _near_duplicates(docs, words, num, den, id_col, known_lengths, block, deal)


def _near_duplicates(docs: DataFrame, words: int, num: int, den: int, id_col: str, known_lengths: int, block: int,
                     deal: int) -> DataFrame:
    kind = docs.schema[0].dataType.simpleString()

    def sizes_of(shingler, batch):
        sets = [shingler(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
             pa.array([set_key(s) if len(s) else None for s in sets], pa.int64()), batch.column(2)],
            names=["_id", "n", "c", "text_hash"])

    sizes = materialize(_sets(docs.withColumn("text_hash", F.xxhash64("_text")), words, sizes_of,
                              f"_id {kind}, n bigint, c bigint, text_hash bigint"))
    real = docs.where(F.col("_id").isNotNull())
    classes = (sizes.where("_id is not null and c is not null").groupBy("c")
               .agg(F.min("_id").alias("_rep"), F.first("n").alias("n"), F.count("*").alias("members")))
    total, rows = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    with scratch() as used:
        lengths = list_lengths(real, words, total, known_lengths)
        groups = components(chains(postings(real, words, num, den, lengths), num, den))
        links = materialize(_search(real, classes, groups, words, num, den, block))
    joined = components(links)
    drop_materialized(docs.sparkSession, used)
    known = (classes.drop("members").join(joined, F.col("c") == F.col("node"), "left")
             .select("c", "_rep", F.coalesce("component", "c").alias("root")))
    least = known.groupBy("root").agg(F.min("_rep").alias("component_id"))
    of_class = known.join(least, "root").select(F.col("c").alias("_c"), "component_id")
    # a class of very many copies is dealt by id, and its one row goes to every deal
    share = max(deal, -(-rows // MOST_LARGE))
    large = classes.where(F.col("members") > share).select(F.col("c").alias("_large"), F.ceil(F.col("members") / share).alias("deals"))
    dealt = (sizes.join(F.broadcast(large), F.col("c") == F.col("_large"), "left")  # at most rows / share classes
             .withColumn("deal", F.expr("pmod(xxhash64(_id), coalesce(deals, 1L))")))
    of_class = (of_class.join(F.broadcast(large), F.col("_c") == F.col("_large"), "left")
                .select("_c", "component_id", F.explode(F.expr("sequence(0L, coalesce(deals, 1L) - 1L)")).alias("_deal")))
    return (dealt.join(of_class, (F.col("c") == F.col("_c")) & (F.col("deal") == F.col("_deal")) & F.col("_id").isNotNull(), "left")
            .select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"),
                    F.coalesce("component_id", "_id").alias("component_id"), "text_hash"))


def _in_blocks(found: DataFrame, block: int, deal: int = 1 << 16) -> DataFrame:
    """`found` (c, n, g, ..) with `part`: each group, by size, in blocks of about `block` shingles.

    Classes of one group and size are dealt to buckets of about `deal`; the buckets of a
    group are added up, and a window over classes holds one bucket.
    """
    dealt = (found.join(found.groupBy("g", "n").agg(F.ceil(F.count("*") / deal).alias("deals")), ["g", "n"])
             .withColumn("deal", F.pmod(F.xxhash64("c"), F.col("deals"))).drop("deals"))
    up_to = Window.partitionBy("g").orderBy("n", "deal")
    cells = (dealt.groupBy("g", "n", "deal").agg(F.sum("n").alias("held"))
             .select("g", "n", "deal", (F.sum("held").over(up_to) - F.col("held")).alias("before")))
    rank = F.row_number().over(Window.partitionBy("g", "n", "deal").orderBy("c"))
    return (dealt.withColumn("rank", rank).join(cells, ["g", "n", "deal"])
            .withColumn("part", F.floor((F.col("before") + (F.col("rank") - 1) * F.col("n")) / block).cast("int"))
            .drop("deal", "rank", "before"))


def _may_be(docs: DataFrame, ids: DataFrame, bits: int = 24) -> DataFrame:
    """The rows of `docs` whose `_id` is among `ids` (_rep), and few others: a bitmap of 2**`bits` ids by hash is broadcast."""
    place = lambda c: F.expr(f"pmod(xxhash64({c}), {1 << bits}L)")
    bitmap = (ids.select(place("_rep").alias("at")).groupBy(F.shiftright("at", 6).alias("_word"))
              .agg(F.expr("bit_or(shiftleft(1L, cast(at & 63 as int)))").alias("_bits")))
    docs = docs.withColumn("_at", place("_id"))
    hit = (F.shiftright("_at", 6) == F.col("_word")) & F.expr("shiftright(_bits, cast(_at & 63 as int)) & 1 = 1")
    return docs.join(F.broadcast(bitmap), hit, "left_semi").drop("_at")


def _search(docs: DataFrame, classes: DataFrame, groups: DataFrame, words: int, num: int, den: int,
            block: int) -> DataFrame:
    """(a, b): links between classes, searched within each group of candidates."""
    found = materialize(classes.join(groups.withColumnRenamed("node", "c"), "c")
                        .select("c", "n", "_rep", F.col("component").alias("g")))
    placed = materialize(_in_blocks(found, block))
    parts = placed.groupBy("g", "part").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    several = parts.groupBy("g").agg(F.max("part").alias("last")).where("last > 0")
    large = parts.join(several, "g").select("g", "part", "low", "high")
    # blocks of one group whose sizes can link, each with itself included
    pairs = (large.select("g", F.col("part").alias("i"), "high")
             .join(large.select("g", F.col("part").alias("j"), "low"), "g")
             .where((F.col("i") == F.col("j")) | ((F.col("i") < F.col("j")) & (F.col("high") * den >= F.col("low") * num))))
    tasks = (pairs.select("g", F.explode(F.array_distinct(F.array("i", "j"))).alias("part"), "i", "j")
             .groupBy("g", "part").agg(F.collect_list(F.struct("i", "j")).alias("tasks")))
    volume = found.agg(F.sum("n")).first()[0] or 0
    bundles = max(1, volume // block)  # groups of one block are searched together, about a block at a time
    wanted = (placed.join(tasks, ["g", "part"], "left")
              .select("c", "_rep", "g", "part", F.col("tasks").alias("tasks")))
    with_text = _may_be(docs, found).join(wanted, F.col("_id") == F.col("_rep")).select("c", "g", "part", "tasks", "_text")

    def sets_of(batches):
        shingler = Shingler(words)
        for batch in batches:
            sets = [shingler(t) for t in batch.column(4).to_pylist()]
            keep = [set_key(s) == c for s, c in zip(sets, batch.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array([s.tobytes() for s in sets], pa.binary())],
                                             names=["c", "g", "part", "tasks", "s"]).filter(pa.array(keep, pa.bool_()))
        let_go()

    sets = with_text.mapInArrow(sets_of, "c bigint, g bigint, part int, tasks array<struct<i: int, j: int>>, s binary")
    keyed = sets.select("c", "g", "part", "s", F.explode(F.coalesce(
        "tasks", F.array(F.struct(F.lit(-1).alias("i"), F.lit(-1).alias("j"))))).alias("t"))
    keyed = keyed.select("c", "g", "part", "s", F.col("t.i").alias("i"), F.col("t.j").alias("j"),
                         F.when(F.col("t.i") < 0, F.pmod(F.xxhash64("g"), F.lit(bundles))).otherwise(F.col("g")).alias("bundle"))

    def search(key, frame):
        out = []
        for _, group in frame.drop_duplicates(["g", "c"]).groupby("g", sort=False):
            sets_ = [np.frombuffer(s, dtype=np.uint64) for s in group["s"]]
            names, part = group["c"].to_numpy(), group["part"].to_numpy()
            order = sorted(range(len(sets_)), key=lambda k: (part[k], len(sets_[k]), names[k]))
            split = int((part == part.min()).sum()) if part.min() != part.max() else 0
            out += [(names[order[x]], names[order[y]]) for x, y in divide_skip([sets_[k] for k in order], num, den, split)]
        return pd.DataFrame(out, columns=["a", "b"])

    return keyed.groupBy("bundle", "i", "j").applyInPandas(search, "a bigint, b bigint")

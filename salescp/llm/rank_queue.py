"""Byte-pair merges by a hierarchical-bitmap rank queue, on many pre-tokens at once.

All pre-tokens of a batch lie one behind the other in one doubly linked list of
positions, with no link across a pre-token's ends.  Every adjacent pair whose
concatenation is a vocabulary entry waits in the bucket of its merge rank.  A
two-level bitmap over the ranks marks the buckets that hold entries; the first
set bit is the next rank.  A popped bucket's entries are checked against the
pair that now starts at the position (stale ones are skipped) and merged
together with array operations; the pairs that a merge creates are pushed into
their own buckets.

Order.  A single pre-token is merged lowest rank first, leftmost first among
equal ranks.  Entries of one bucket may be merged together when no merge can
give its own result a lower rank than its own; `Vocabulary.returning` marks
the ranks for which that fails, and of those buckets only the leftmost entry
of each pre-token is merged before the queue is asked again.  So a rank file
of any kind gives the reference order, and a pre-token of a million characters
costs no more per character than many short ones.
"""

from __future__ import annotations

import base64
import heapq

import numpy as np

NONE = 1 << 30
SLOTS = 8


class Vocabulary:
    """Ranks by bytes (a tiktoken rank file), prepared for pair look-ups."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.size = max(ranks.values()) + 1
        self.tokens: list[bytes] = [b""] * self.size
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.byte_rank = np.array([ranks.get(bytes([b]), -1) for b in range(256)], dtype=np.int64)
        if (self.byte_rank < 0).any():
            raise ValueError("the rank file lacks single bytes")
        left, right, made = [], [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a = ranks.get(token[:cut])
                if a is not None:
                    b = ranks.get(token[cut:])
                    if b is not None:
                        left.append(a), right.append(b), made.append(rank)
        left, right, made = (np.array(x, dtype=np.int64) for x in (left, right, made))
        self.bits = max(1, int(self.size).bit_length())
        if 3 * self.bits > 62:
            raise ValueError("vocabulary too large for the pair table")
        self.returning = np.zeros(self.size, dtype=bool)
        self.returning[left[made < left]] = True
        self.returning[right[made < right]] = True
        self._table((left << self.bits) | right, made)
        self.lengths = np.array([len(t) for t in self.tokens], dtype=np.int64)
        self.flat = np.frombuffer(b"".join(self.tokens), dtype=np.uint8)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])

    @classmethod
    def load(cls, path: str) -> "Vocabulary":
        with open(path, "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})

    def _hash(self, keys):
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.log)).astype(np.int64)

    def _table(self, keys, made):
        self.log = max(4, int(len(keys) // 3).bit_length())
        while True:
            home = self._hash(keys)
            order = np.argsort(home, kind="stable")
            sorted_home = home[order]
            slot = np.arange(len(keys)) - np.searchsorted(sorted_home, sorted_home)
            if not len(slot) or slot.max() < SLOTS:
                break
            self.log += 1
        self.cells = np.zeros((1 << self.log, SLOTS), dtype=np.int64)
        self.cells[sorted_home, slot] = (((keys << self.bits) | made) + 1)[order]

    def pair_rank(self, left, right):
        """Rank of left+right, NONE where the pair does not merge."""
        key = (left.astype(np.int64) << self.bits) | right
        cell = self.cells[self._hash(key)] - 1
        found = np.where((cell >> self.bits) == key[:, None], cell, -1).max(axis=1)
        return np.where(found >= 0, found & ((1 << self.bits) - 1), NONE)

    def decode(self, ids) -> bytes:
        """The bytes of a sequence of ids."""
        ids = np.asarray(ids, dtype=np.int64)
        n = self.lengths[ids]
        total = int(n.sum())
        if not total:
            return b""
        ends = np.cumsum(n)
        return self.flat[np.arange(total) + np.repeat(self.starts[ids] - (ends - n), n)].tobytes()


class RankQueue:
    """Buckets of positions by rank under a two-level bitmap of 256-way nodes."""

    def __init__(self, size: int):
        self.leaf = np.zeros(((size >> 8) + 1) << 8, dtype=bool)
        self.top = np.zeros((size >> 8) + 1, dtype=bool)
        self.buckets: list[list | None] = [None] * size

    def push(self, ranks, positions):
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        heads = np.flatnonzero(np.concatenate(([True], ranks[1:] != ranks[:-1])))
        firsts = ranks[heads]
        self.leaf[firsts] = True
        self.top[firsts >> 8] = True
        cuts = heads.tolist()
        cuts.append(len(ranks))
        buckets = self.buckets
        for k, rank in enumerate(firsts.tolist()):
            part = positions[cuts[k]:cuts[k + 1]]
            if buckets[rank] is None:
                buckets[rank] = [part]
            else:
                buckets[rank].append(part)

    def pop(self):
        """(lowest rank, its positions), or None; find-first-set on both levels."""
        node = int(self.top.argmax())
        if not self.top[node]:
            return None
        low = node << 8
        rank = low + int(self.leaf[low:low + 256].argmax())
        self.leaf[rank] = False
        if not self.leaf[low:low + 256].any():
            self.top[node] = False
        parts, self.buckets[rank] = self.buckets[rank], None
        return rank, parts[0] if len(parts) == 1 else np.concatenate(parts)


def _distinct(positions):
    positions = np.sort(positions)
    return positions[np.concatenate(([True], positions[1:] != positions[:-1]))]


def encode_pieces(vocab: Vocabulary, pieces: list[bytes], batch_bytes: int = 1 << 20) -> list[bytes]:
    """Ids of each pre-token, as little-endian int32 bytes (empty pre-token: no id).

    The queue takes whole pre-tokens, together about `batch_bytes` at a time, or
    a single longer one; a handful of short ones goes one entry at a time.
    """
    if sum(map(len, pieces)) < 256:
        return [np.array(encode_one(vocab, p), dtype="<i4").tobytes() for p in pieces]
    out, part, size = [], [], 0
    for piece in pieces:
        if part and size + len(piece) > batch_bytes:
            out += _encode(vocab, part)
            part, size = [], 0
        part.append(piece)
        size += len(piece)
    return out + _encode(vocab, part) if part else out


def encode_one(vocab: Vocabulary, piece: bytes) -> list[int]:
    """The same queue for one pre-token, an entry at a time: leftmost entry of the lowest rank's bucket."""
    tok, n = vocab.byte_rank[np.frombuffer(piece, dtype=np.uint8)].tolist(), len(piece)
    if n < 2:
        return tok
    tokens, ranks = vocab.tokens, vocab.ranks
    nxt, prv, pair = list(range(1, n + 1)), list(range(-1, n - 1)), [None] * n
    buckets: dict[int, list[int]] = {}
    leaf: dict[int, int] = {}
    top = 0

    def push(at):
        nonlocal top
        rank = pair[at] = ranks.get(tokens[tok[at]] + tokens[tok[nxt[at]]]) if nxt[at] < n else None
        if rank is not None:
            if rank in buckets:
                heapq.heappush(buckets[rank], at)
            else:
                buckets[rank] = [at]
                leaf[rank >> 8] = leaf.get(rank >> 8, 0) | 1 << (rank & 255)
                top |= 1 << (rank >> 8)

    for at in range(n - 1):
        push(at)
    while top:
        node = (top & -top).bit_length() - 1
        rank = node << 8 | (leaf[node] & -leaf[node]).bit_length() - 1
        at = heapq.heappop(buckets[rank])
        if not buckets[rank]:
            del buckets[rank]
            leaf[node] &= leaf[node] - 1
            if not leaf[node]:
                top &= top - 1
        if pair[at] != rank:
            continue  # stale
        gone = nxt[at]
        tok[at], nxt[at], pair[gone], tok[gone] = rank, nxt[gone], None, -1
        if nxt[at] < n:
            prv[nxt[at]] = at
        push(at)
        if prv[at] >= 0:
            push(prv[at])
    return [t for t in tok if t >= 0]


def _encode(vocab: Vocabulary, pieces: list[bytes]) -> list[bytes]:
    lengths = np.array([len(p) for p in pieces], dtype=np.int64)
    n = int(lengths.sum())
    if not n:
        return [b""] * len(pieces)
    kind = np.int32 if n < 2**31 - 4 else np.int64
    tok = np.empty(n + 2, dtype=np.int32)
    tok[:n] = vocab.byte_rank[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
    tok[n:] = vocab.size  # the end sentinel makes no pair
    ends = np.cumsum(lengths)
    nxt = np.arange(1, n + 3, dtype=kind)
    prv = np.arange(-1, n + 1, dtype=kind)
    full = lengths > 0
    nxt[ends[full] - 1] = n
    prv[(ends - lengths)[full]] = n + 1
    owner = np.repeat(np.arange(len(pieces), dtype=np.int32), lengths)
    alive = np.ones(n, dtype=bool)
    pair = np.full(n + 2, NONE, dtype=np.int32)
    at = np.flatnonzero(nxt[:n] != n)
    pair[at] = vocab.pair_rank(tok[at], tok[nxt[at]])
    queue = RankQueue(vocab.size)
    at = at[pair[at] < NONE]
    if len(at):
        queue.push(pair[at], at)
    while (popped := queue.pop()) is not None:
        rank, at = popped
        at = at[pair[at] == rank]  # stale entries are skipped
        if not len(at):
            continue
        if len(at) > 1:
            at = _distinct(at)
            if vocab.returning[rank]:
                first = np.concatenate(([True], owner[at[1:]] != owner[at[:-1]]))
                if not first.all():
                    queue.push(np.full(int((~first).sum()), rank, dtype=np.int32), at[~first])
                    at = at[first]
            else:
                joined = np.concatenate(([False], nxt[at[:-1]] == at[1:]))
                if joined.any():  # a run of overlapping pairs: every second one, from its left end
                    index = np.arange(len(at))
                    start = np.maximum.accumulate(np.where(joined, 0, index))
                    at = at[((index - start) & 1) == 0]
        gone = nxt[at]
        after = nxt[gone]
        tok[at] = rank
        nxt[at] = after
        prv[after] = at
        alive[gone] = False
        pair[gone] = NONE
        before = prv[at]
        touched = np.concatenate((at, before[before <= n]))
        if len(touched) > len(at) and len(at) > 1:
            touched = _distinct(touched)
        right = nxt[touched]
        fresh = vocab.pair_rank(tok[touched], tok[right])
        pair[touched] = fresh
        real = fresh < NONE
        if real.any():
            queue.push(fresh[real], touched[real])
    ids = tok[:n][alive].astype("<i4").tobytes()
    counts = np.zeros(len(pieces) + 1, dtype=np.int64)
    counts[1:] = np.bincount(owner[alive], minlength=len(pieces))
    cut = (np.cumsum(counts) * 4).tolist()
    return [ids[a:b] for a, b in zip(cut[:-1], cut[1:])]

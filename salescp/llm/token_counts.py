"""Token counts that follow edits.

Each document has a segment tree over its pre-tokens: the leaves, in blocks,
hold (characters, token count) of each pre-token, the inner nodes the sums.  An
edit descends to the block it touches, re-scans the text from a few characters
before the edit until the new pre-token boundaries meet an old one again,
encodes only those pre-tokens and updates the sums on the paths to the root.

The pattern scans left to right and looks at most `CONTEXT` characters beyond
the end of a match (a contraction's two letters; the last of a run of spaces
and what follows it).  So pre-tokens that end that far before an edit stand,
and from a boundary behind the edit that is old and new everything stands.

Defined results: a null text counts as empty; null edits or an empty list
change nothing; an edit's start and length are clamped to the text as it then
is, a null part of an edit counts as 0 or the empty text; edits apply in list
order, each to the text that the earlier ones left.  One result per input row,
repeated or null ids included; texts of any length are counted whole; an empty
table gives no rows; columns other than id, text and edits are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import Encoder, slices

CONTEXT = 3
EDITS = "array<struct<start: bigint, removed: bigint, inserted: string>>"


class CountTree:
    """Segment tree of one document."""

    def __init__(self, encoder: Encoder, text: str, block: int = 64):
        self.encoder, self.block, self.encoded = encoder, block, 0
        self._build(text, encoder.leaves(text))

    def _build(self, text, leaves):
        n = len(leaves)
        cuts = np.arange(0, n, self.block)
        self.m = max(1, len(cuts))
        self.width = 1 << (self.m - 1).bit_length()
        self.sums = np.zeros((2 * self.width, 2), dtype=np.int64)
        if n:
            self.sums[self.width:self.width + self.m] = np.add.reduceat(leaves, cuts, axis=0, dtype=np.int64)
        at = self.width
        while at > 1:  # level by level
            half = at >> 1
            self.sums[half:at] = self.sums[at:2 * at].reshape(half, 2, 2).sum(axis=1)
            at = half
        ends = np.cumsum(self.sums[self.width:self.width + self.m, 0])
        self.texts = [text[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]
        self.leaves = [leaves[a:a + self.block] for a in cuts.tolist()] or [leaves]

    @property
    def chars(self) -> int:
        return int(self.sums[1, 0])

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    def _find(self, position: int):
        """(block, position of its first character) of the block holding a position."""
        node, base = 1, 0
        while node < self.width:
            node *= 2
            left = int(self.sums[node, 0])
            if position >= base + left and self.sums[node + 1, 0]:
                base += left
                node += 1
        return node - self.width, base

    def _store(self, block: int, text: str, leaves) -> None:
        self.texts[block], self.leaves[block] = text, leaves
        node = block + self.width
        self.sums[node] = leaves.sum(axis=0) if len(leaves) else 0
        while node > 1:
            node >>= 1
            self.sums[node] = self.sums[2 * node] + self.sums[2 * node + 1]

    def edit(self, start: int, removed: int, inserted: str) -> None:
        start = min(max(start, 0), self.chars)
        end = start + min(max(removed, 0), self.chars - start)
        first, base = self._find(max(0, start - CONTEXT))
        ends = np.cumsum(self.leaves[first][:, 0]) + base if len(self.leaves[first]) else np.zeros(0, dtype=np.int64)
        keep = int(np.searchsorted(ends, start - CONTEXT, side="right"))  # leaves that end early enough stand
        origin = int(ends[keep - 1]) if keep else base
        last, last_base = self._find(end)
        while True:
            old = "".join(self.texts[first:last + 1])[origin - base:]
            bounds = np.concatenate([self.leaves[first][keep:, 0], *(x[:, 0] for x in self.leaves[first + 1:last + 1])])
            bounds = np.cumsum(bounds)
            new = old[:start - origin] + inserted + old[end - origin:]
            shift = len(inserted) - (end - start)
            closed = last + 1 >= self.m
            meets = set((bounds[bounds >= end - origin] + shift).tolist())
            pieces, at, done = [], 0, not new
            while at < len(new):
                found = self.encoder.match(new, at).group()
                at += len(found)
                if not closed and at > len(new) - CONTEXT:
                    break  # what follows could change this match
                pieces.append(found)
                if at in meets and at >= start - origin + len(inserted):
                    done = True
                    break
            if done or closed:
                break
            last = min(self.m - 1, last + max(1, last - first))  # no meeting yet: take in more blocks
        self.encoded += len(pieces)
        mid = np.array(list(zip(map(len, pieces), self.encoder.count(pieces))), dtype=np.int64).reshape(-1, 2)
        rest = np.concatenate([self.leaves[first][keep:], *self.leaves[first + 1:last + 1]])
        tail = rest[int(np.searchsorted(bounds, at - shift, side="right")):] if at < len(new) else rest[:0]
        text = "".join(self.texts[first:last + 1])[:origin - base] + new
        whole = np.concatenate([self.leaves[first][:keep], mid, tail])
        for block in range(first + 1, last + 1):
            self._store(block, "", whole[:0])
        self._store(first, text, whole)
        if len(whole) > 16 * self.block:  # one block took in too much: balance again
            self._build("".join(self.texts), np.concatenate(self.leaves))


def attach_edits(docs: DataFrame, edits: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Documents with their edits (id, seq, start, removed, inserted) as an ordered list."""
    lists = (edits.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_edit_id"))
             .agg(F.sort_array(F.collect_list(F.struct("seq", "start", "removed", "inserted"))).alias("_e")))
    lists = lists.select("_edit_id", F.expr(
        f"cast(transform(_e, e -> named_struct('start', e.start, 'removed', e.removed, 'inserted', e.inserted)) as {EDITS})"
    ).alias("edits"))
    return docs.drop("edits").join(lists, F.col(id_col) == F.col("_edit_id"), "left").drop("_edit_id")


def edited_counts(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                  edits_col: str = "edits", batch_chars: int = 1 << 25) -> DataFrame:
    """Token counts of each document before and after its list of edits.

    n_tokens_before, n_tokens: the root sums; n_edits; n_reencoded: pre-tokens
    encoded anew for the edits; edited_chars: characters after the edits.
    """
    docs = docs.select(F.col(id_col), F.col(text_col).alias("text"), F.col(edits_col).cast(EDITS).alias("edits"))
    names = ("n_pretokens", "n_tokens_before", "n_tokens", "n_edits", "n_reencoded", "edited_chars")

    def run(batches):
        encoder = Encoder.of_worker(path, pattern)
        for batch in batches:
            texts, edits, at, rows = batch.column(1).to_pylist(), batch.column(2).to_pylist(), 0, []
            for part in slices(texts, batch_chars):
                encoder.prepare(part, layout=True)
                for text in part:
                    tree = CountTree(encoder, text)
                    pretokens, before = sum(map(len, tree.leaves)), tree.tokens
                    todo = edits[at] or []
                    for e in todo:
                        e = e or {}
                        tree.edit(e.get("start") or 0, e.get("removed") or 0, e.get("inserted") or "")
                    rows.append((pretokens, before, tree.tokens, len(todo), tree.encoded, tree.chars))
                    at += 1
            cols = zip(*rows) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in cols)],
                                             names=[id_col, *names])

    kind = docs.schema[0].dataType.simpleString()
    return docs.mapInArrow(run, f"{id_col} {kind}, " + ", ".join(f"{n} bigint" for n in names))

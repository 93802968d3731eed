"""Cross-tokenizer alignment against whole texts encoded by the libraries and every pair of ranges."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
from conftest import SF_SMALL
from llm.conftest import ODD

from salescp.llm import alignment, queries

A, B = (public_tokenizers.path(n) for n in (queries.BYTE_BPE_JSON, queries.PIECE_BPE))


@pytest.fixture(scope="module")
def vocab():
    return alignment.Vocabularies(A, B)


def plain_rows(rows, vocab):
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, digest) and the pair counts, by comparing byte ranges."""
    docs, count = [], Counter()
    for i, text in rows:
        raw = b" " + (text or "").encode()
        a = vocab.a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = vocab.b.encode(text) if text else []
        if b"".join(vocab.a_bytes[k] for k in a) != raw or b"".join(vocab.b_bytes[k] for k in b) != raw:
            a = b = []
        spans = []
        for ids, own in ((a, vocab.a_bytes), (b, vocab.b_bytes)):
            at, out = 0, []
            for k in ids:
                out.append((at, at + len(own[k]), k))
                at += len(own[k])
            spans.append(out)
        ends = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, start = [], 0
        for e in ends:
            groups.append(tuple([s for s in side if start <= s[0] < e] for side in spans))
            start = e
        links = [(x[2], y[2]) for xs, ys in groups for x in xs for y in ys if x[0] < y[1] and y[0] < x[1]]
        count.update(links)
        spelt = ";".join(f"{','.join(str(k) for *_, k in xs)}|{','.join(str(k) for *_, k in ys)}" for xs, ys in groups)
        docs.append((i, len(a), len(b), len(groups), links, hashlib.sha256(spelt.encode()).hexdigest() if spelt else ""))
    most = Counter()
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    return Counter((i, na, nb, g, len(ls), sum(count[p] == most[p[1]] for p in ls), sum(count[p] for p in ls), h)
                   for i, na, nb, g, ls, h in docs), count


def texts(seed, n):
    rng = random.Random(seed)
    parts = ["word", " ", "  ", "\n", "\t", "Émile", "don't", "'s", "123", "4567", "漢字", "\U0001f600", "á", "▁", "<s>", "</s>",
             "<|endoftext|>", "<unk>", "<0x41>", "A", "\x00", "\x1c", " ", "　", "\r\n", "unbelievably", "Zwischenraum",
             "_", "::", "};\r", "ﬁ"]
    return ["".join(rng.choice(parts) + rng.choice(["", " ", " ", "\n", "   "]) for _ in range(rng.choice([1, 2, 5, 20])))
            for _ in range(n)]


@pytest.mark.parametrize("ranked", [True, False])
def test_units_are_encoded_as_within_their_text(vocab, ranked):
    assert vocab.separable
    every = [t for t in texts(1, 3000) if t] + ["x" * 3000, "ab " * 900]
    aligner = alignment.Aligner(A, B, public_tokenizers.PATTERN if ranked else None)
    assert (aligner.vocab.ranked is not None) == ranked
    for text, (numbers, spelt, *_) in zip(every, aligner.documents(every)):
        whole, whole_spelt, *_ = aligner.aligned(text, vocab.a.encode(" " + text, add_special_tokens=False).ids, vocab.b.encode(text))
        assert (tuple(numbers[:4]), spelt) == (tuple(whole[:4]), whole_spelt), repr(text)
        assert "▁" not in text or not spelt


def test_a_small_cache_gives_the_same(vocab):
    every = texts(5, 400)
    large, small = (alignment.Aligner(A, B, public_tokenizers.PATTERN, n) for n in (250_000, 40))
    for at in range(0, 400, 20):
        one, two = ([(tuple(x[0]), *x[1:]) for x in al.documents(every[at:at + 20])] for al in (large, small))
        assert one == two
    assert len(small.index) < len(large.index) / 2 and small.hits.max() > 1
    small.shrink()
    assert 0 < len(small.index) <= 20 and [small.spelt[k] for k in small.index.values()] == [large.spelt[large.index[u]] for u in small.index]


def test_identity_map_joins_equal_bytes(vocab):
    known = {t: k for k, t in enumerate(vocab.b_bytes)}
    assert sum(k >= 0 for k in vocab.same) > 10_000
    for k, same in enumerate(vocab.same):
        assert vocab.b_bytes[same] == vocab.a_bytes[k] if same >= 0 else vocab.a_bytes[k] not in known


@pytest.mark.parametrize("known", [0, 300, 1 << 18])
def test_alignment_equals_brute_force(spark, make_docs, vocab, known):
    rows = [*ODD, *((100 + k, t) for k, t in enumerate(texts(2, 60))), (100, "the same id again"), (7000, "x " * 3000)]
    docs, pairs = alignment.align(make_docs(rows, extra=True), A, B, known_pairs=known)
    expect, count = plain_rows(rows, vocab)
    assert Counter(map(tuple, docs.collect())) == expect
    got = {(r.a, r.b): (r["count"], r.best) for r in pairs.collect()}
    assert {k: n for k, (n, _) in got.items()} == dict(count)
    for (_, b), (n, best) in got.items():
        assert best == (n == max(m for (_, y), (m, _) in got.items() if y == b))


def test_alignment_of_a_table(spark, vocab):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    expect, _ = plain_rows([(r.doc_id, r.text) for r in docs.collect()], vocab)
    assert Counter(map(tuple, queries.op11_alignment(spark, SF_SMALL).collect())) == expect


def test_groups_and_nothing(make_docs):
    docs, _ = alignment.align(make_docs([(1, "unbelievably so")]), A, B, with_groups=True)
    row = docs.collect()[0]
    assert hashlib.sha256(row.groups.encode()).hexdigest() == row.groups_sha256 and row.groups.count(";") == row.n_groups - 1
    for rows in ([], [(1, None), (None, "")]):
        docs, pairs = alignment.align(make_docs(rows), A, B)
        assert [tuple(r)[1:] for r in docs.collect()] == [(0, 0, 0, 0, 0, 0, "")] * len(rows) and pairs.count() == 0


def test_pair_counts_keep_every_count():
    import numpy as np

    rng, counts, whole = np.random.default_rng(1), alignment.PairCounts(most=50), Counter()
    for _ in range(60):
        codes, n = np.unique(rng.integers(0, 400, 30), return_counts=True)
        for c, m in counts.add(codes, n):
            whole.update(dict(zip(c.tolist(), m.tolist())))
            assert len(c) > 50
    c, m = counts.take()
    whole.update(dict(zip(c.tolist(), m.tolist())))
    rng, expect = np.random.default_rng(1), Counter()
    for _ in range(60):
        expect.update(rng.integers(0, 400, 30).tolist())
    assert whole == expect

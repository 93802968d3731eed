"""Byte BPE (2), edit-aware counts (9) and packing (5) against the public libraries."""

import base64
import hashlib
import json
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from llm.conftest import ODD
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from salescp.llm import bpe, packing, queries, token_counts
from salescp.llm.rank_queue import Vocabulary, encode_one, encode_pieces

PATH = P.path("byte_bpe_50k.tiktoken")
FRAGMENTS = ["the", " ", "  ", "\n", " \n", "'s", "'re", "'r", "e", "'", "don't", " 123", "45", "é", "ß ", "!!", "$$$ ", "　",
             "漢字", "\x1c", "\t", "aaaa", "<|endoftext|>", "re", "LL", " X", "İ", "Σ", "ª", "×", "\x85", "\xa0", "Ä"]


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def text_of(rng, n):
    return "".join(rng.choice(FRAGMENTS) for _ in range(n))


def test_rank_queue_is_the_librarys_merge_order(library):
    vocab, rng = Vocabulary.load(PATH), random.Random(1)
    alphabets = [b"ab", b" a", b"abc", b"=-", b"0123", b"\xc3\xa9\xe4", b"aeinrst", bytes(range(256))]
    pieces = [bytes(rng.choice(rng.choice(alphabets)) for _ in range(rng.choice([1, 2, 5, 30, 300]))) for _ in range(800)]
    pieces += [b"a" * 30_001, b"", b"ab" * 20_000]
    expect = [library._encode_single_piece(p) if p else [] for p in pieces]
    assert [np.frombuffer(o, "<i4").tolist() for o in encode_pieces(vocab, pieces)] == expect
    assert [encode_one(vocab, p) for p in pieces[:500]] == expect[:500]
    assert all(vocab.decode(e) == p for p, e in zip(pieces, expect))


def test_a_rank_file_whose_merges_return_to_lower_ranks():
    """A longer token ranked before its part: the leftmost-first order of a single queue must hold."""
    rng = random.Random(5)
    for _ in range(20):
        extra = list({bytes(rng.choice(b"ab") for _ in range(rng.randint(2, 5))) for _ in range(12)})
        rng.shuffle(extra)
        ranks = {bytes([b]): b for b in range(256)} | {t: 256 + k for k, t in enumerate(extra)}
        vocab = Vocabulary(ranks)
        own = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
        pieces = [bytes(rng.choice(b"ab") for _ in range(40)) for _ in range(30)]
        for got, p in zip(encode_pieces(vocab, pieces), pieces):
            assert np.frombuffer(got, "<i4").tolist() == own._encode_single_piece(p) == encode_one(vocab, p)


def test_op2_rows(spark, odd, library, tmp_path):
    rng = random.Random(2)
    more = [(100 + i, text_of(rng, rng.choice([0, 1, 3, 20, 200]))) for i in range(300)]
    rows = ODD + more
    odd.select("doc_id", "text", "lang", "source", "n_chars").union(spark.createDataFrame(
        [(i, t, "en", "s", len(t)) for i, t in more], odd.select("doc_id", "text", "lang", "source", "n_chars").schema)
    ).write.parquet(f"{tmp_path}/documents.parquet")

    def digest(t):
        ids = library.encode_ordinary(t or "")
        return (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256((t or "").encode()).hexdigest())

    got = Counter(map(tuple, queries.op2_byte_bpe(spark, str(tmp_path)).collect()))
    assert got == Counter((i, *digest(t)) for i, t in rows)


def test_encode_gives_ids_and_round_trips(odd):
    out = bpe.encode_decode(odd, PATH, P.PATTERN).collect()
    assert len(out) == len(ODD)
    assert Counter(bytes(r.decoded).decode() for r in out) == Counter(t or "" for _, t in ODD)


def test_empty_tables(make_docs):
    empty = make_docs([])
    assert bpe.encode_decode(empty, PATH, P.PATTERN).collect() == []
    assert packing.pack_documents(empty, P.path("word_bpe_49k.json")).collect() == []
    assert token_counts.edited_counts(empty.withColumn("edits", F.expr(f"cast(null as {token_counts.EDITS})")), PATH, P.PATTERN).collect() == []


def test_count_tree_follows_edits(library):
    encoder, rng = bpe.Encoder(PATH, P.PATTERN), random.Random(3)
    for n in [0, 1, 2, 5, 20, 60, 200] * 12:
        now = text_of(rng, n)
        tree = token_counts.CountTree(encoder, now, block=rng.choice([2, 8, 64]))
        for _ in range(5):
            start, removed, inserted = rng.randint(0, len(now) + 2), rng.choice([0, 0, 1, 2, 5, 50]), text_of(rng, rng.choice([0, 1, 3, 40]))
            tree.edit(start, removed, inserted)
            start = min(start, len(now))
            now = now[:start] + inserted + now[start + removed:]
            assert (tree.tokens, tree.chars) == (len(library.encode_ordinary(now)), len(now))


def test_only_the_edited_region_is_encoded_again(library):
    encoder = bpe.Encoder(PATH, P.PATTERN)
    tree = token_counts.CountTree(encoder, "some words in a row, " * 5000)
    tree.edit(50_000, 3, "other")
    assert 0 < tree.encoded < 10


def test_op9_rows(spark, odd, library, tmp_path):
    odd.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    edits = docs.withColumn("n", F.coalesce(F.char_length("text"), F.lit(0))).select("doc_id", "text", F.expr(queries.OP9_EDITS).alias("e"))
    expect = Counter()
    for r in edits.collect():
        now = r.text or ""
        for e in r.e:
            at, gone, new = min(max(e.start or 0, 0), len(now)), max(e.removed or 0, 0), e.inserted or ""
            now = now[:at] + new + now[at + gone:]
        expect[r.doc_id, len(library.encode_ordinary(r.text or "")), len(library.encode_ordinary(now)), len(now)] += 1
    got = queries.op9_edit_counts(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.n_tokens_before, r.n_tokens, r.edited_chars) for r in got) == expect


def test_edits_are_joined_in_order(spark, make_docs):
    docs = make_docs([(1, "abc def"), (2, "x"), (None, "y")])
    edits = spark.createDataFrame([(1, 2, 0, 1, "Z"), (1, 1, 0, 0, "QQ "), (None, 1, 0, 1, ""), (2, 1, None, None, None)],
                                  "doc_id bigint, seq int, start bigint, removed bigint, inserted string")
    out = {r.doc_id: r for r in token_counts.edited_counts(token_counts.attach_edits(docs, edits), PATH, P.PATTERN).collect()}
    assert (out[1].edited_chars, out[1].n_edits) == (len("ZQ abc def"), 2)
    assert (out[2].edited_chars, out[2].n_edits, out[None].n_edits) == (1, 1, 0)


def test_cached_tokenizer_is_the_library():
    own = packing.CachedTokenizer(P.path("word_bpe_49k.json"))
    rng = random.Random(7)
    texts = [text_of(rng, rng.choice([0, 1, 2, 5, 20, 200])) for _ in range(600)]
    own.prepare(texts)
    lib = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    for t in texts:
        assert np.frombuffer(own.ids(t), "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids


def test_parts_are_those_of_the_pattern():
    cut, rng = re.compile("[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+").findall, random.Random(8)
    more = ["Ab1!c", "É", "Þßÿ×", "a÷b", "a'b c", "Don't\nSTOP", "<A> b", "12 3", "\n \n", "x\x7fY z", "A\u0301B c", "漢A b"]
    texts = [None, *more, "", *(text_of(rng, rng.choice([0, 1, 2, 5, 20])) for _ in range(400)), "é"]
    for some in (pa.array(texts), pa.array(texts).slice(3, 200), pa.array(["", None]), pa.array([], pa.string()), pa.array(["   "])):
        parts, first = packing.cut_parts(some)
        expect = [[p for c in (t or "").replace("\n", " ").split(" ") if c
                   for p in (cut(c.lower()) if packing._PLAIN.fullmatch(c) else [c])] for t in some.to_pylist()]
        assert [parts.slice(a, b - a).to_pylist() for a, b in zip(first, first[1:])] == expect


class Counted:
    """A tokenizer that counts the texts it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, 0

    def encode_batch_fast(self, texts, **kwargs):
        self.texts += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **kwargs)


def test_new_words_go_to_the_library_together(tmp_path):
    rng = random.Random(12)
    words = ["".join(rng.choice("abcdeé") for _ in range(9)) for _ in range(4000)]
    texts = [" ".join(words[a:a + 50]) + ", it's\n" for a in range(0, len(words), 50)]
    path = P.path("word_bpe_49k.json")
    described = json.loads(open(path).read())
    described["model"] |= {"end_of_word_suffix": None, "merges": [], "vocab": {c: i for i, c in enumerate("abcdeÃ©,")}}
    described["added_tokens"] = []
    (tmp_path / "no_suffix.json").write_text(json.dumps(described))
    for file, most in ((path, 60), (f"{tmp_path}/no_suffix.json", 5000)):
        own, lib = packing.CachedTokenizer(file, 1500, 5), Tokenizer.from_file(file)
        own.tokenizer = Counted(own.tokenizer)
        raw, edges = own.encode(pa.array([*texts, None, ""]))
        assert [np.frombuffer(raw[a:b], "<u4").tolist() for a, b in zip(edges, edges[1:])] == \
            [lib.encode(t, add_special_tokens=False).ids for t in [*texts, "", ""]]
        assert own.tokenizer.texts <= most
        assert [np.frombuffer(own.ids(t), "<u4").tolist() for t in texts[:9]] == [lib.encode(t, add_special_tokens=False).ids for t in texts[:9]]


def check_packing(rows, limit):
    by_sequence = defaultdict(list)
    for r in rows:
        assert 1 <= r.length <= limit
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= limit
    return len(by_sequence)


def test_op5_rows(spark, odd, make_docs, tmp_path):
    rng = random.Random(9)
    rows = ODD + [(100 + i, "word " * rng.choice([0, 1, 7, 300, 300, 300, 5000])) for i in range(200)]
    odd.select("doc_id", "text").union(make_docs(rows[len(ODD):]).select("doc_id", "text")).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op5_best_fit_packing(spark, str(tmp_path)).collect()
    lib, expect = Tokenizer.from_file(P.path("word_bpe_49k.json")), Counter()
    for i, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids + [1]
        for k, a in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[a:a + 4096], dtype="<u4")
            expect[i, k, a, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == expect
    used = check_packing(got, 4096)
    assert used <= -(-sum(r.length for r in got) // 4096) + 1


def test_plan_is_best_fit_longest_first():
    rng = random.Random(11)
    for _ in range(60):
        limit = rng.randint(3, 40)
        histogram = {k: rng.randint(1, 30) for k in rng.sample(range(1, limit + 1), rng.randint(1, limit))}
        room = []
        for length in sorted(histogram, reverse=True):  # one piece after another
            for _ in range(histogram[length]):
                fits = [r for r in room if r >= length]
                best = min(fits) if fits else limit
                if fits:
                    room.remove(best)
                room.append(best - length)
        rows = packing.plan(histogram, limit)
        assert 1 + max(f + (n - 1) // per for _, _, n, per, f, _ in rows) == len(room)
        assert {k: sum(r[2] for r in rows if r[0] == k) for k in histogram} == histogram


def test_packed_ids_make_sequences(make_docs):
    docs = make_docs([(i, "some words " * i) for i in range(1, 40)])
    packed = packing.pack_documents(docs, P.path("word_bpe_49k.json"), limit=64, with_ids=True).cache()
    lengths = {r.sequence_id: len(r.ids) for r in packing.sequences(packed).collect()}
    assert lengths == {r.sequence_id: r.n for r in packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()}
    assert check_packing(packed.collect(), 64) == len(lengths)


def test_let_go_gives_freed_memory_back():
    from salescp.llm.common import let_go
    held = lambda: sum(int(x.split()[1]) for x in open("/proc/self/smaps_rollup") if x.startswith("Pss_Anon"))
    some = [bytes([k % 256]) * 50_000 for k in range(2_000)]
    last = bytes(10)  # keeps the heap's end in use
    del some
    before = held()
    let_go()
    assert held() <= before + 5_000 and last

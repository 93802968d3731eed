"""Line dedup (4), language (3), quality (6), PII (7) and the Jaccard join (8)."""

import base64
import hashlib
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from llm.conftest import ODD
from conftest import SF_ORACLE
from pyspark.sql import functions as F

from salescp import session
from salescp.llm import jaccard_join, language_id, line_dedup, pii, quality, queries

MULTI = P.path("byte_bpe_multi_50k.tiktoken")


# -- line dedup ---------------------------------------------------------------
def plain_line_dedup(rows, min_chars=40, min_docs=5):
    strip = "\t\n\x0b\x0c\r "

    def key(line):
        return re.sub("[A-Z]", lambda m: m.group().lower(), line.strip(strip))

    holders = defaultdict(set)
    for i, t in rows:
        if i is not None:
            for line in (t or "").split("\n"):
                if len(key(line)) >= min_chars:
                    holders[key(line)].add(i)
    out = Counter()
    for i, t in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if i is None or len(holders.get(key(x), ())) < min_docs or max(holders[key(x)]) == i]
        out[i, len(lines), len(lines) - len(keep), hashlib.sha256("\n".join(keep).encode()).hexdigest()] += 1
    return out


def test_line_dedup_equals_a_plain_version(spark, make_docs, tmp_path):
    rng = random.Random(3)
    common = ["A line that MANY documents share, É and all, number %d" % k for k in range(6)] + ["ß" * 39, "ß" * 40, "x" * 40]
    rows = list(ODD)
    for i in range(60):
        lines = [rng.choice(common) for _ in range(rng.randint(0, 6))] + [f"own line {i} {rng.random()}" * 3]
        rng.shuffle(lines)
        pad = rng.choice(["", "  ", "\t"])
        rows.append((100 + i, "\n".join(pad + (x.upper() if rng.random() < 0.2 else x) for x in lines)))
    rows += [rows[-1], (rows[-2][0], "another text\n" + common[0])]  # repeated rows, one id with two texts
    make_docs(rows, extra=True).write.parquet(f"{tmp_path}/documents.parquet")
    got = Counter(map(tuple, queries.op4_line_dedup(spark, str(tmp_path)).collect()))
    assert got == plain_line_dedup(rows)
    kept = line_dedup.dedup_lines(make_docs(rows, extra=True))
    assert set(make_docs(rows, extra=True).columns) < set(kept.columns) and kept.count() == len(rows)


def test_line_dedup_of_nothing(make_docs):
    assert line_dedup.dedup_lines(make_docs([])).collect() == []


def test_a_text_of_very_many_lines_is_rebuilt_in_linear_time(make_docs):
    shared = "this line is shared by all of the six documents, number "
    rows = [(i, "\n".join([shared + "0"] + [f"{i} {k}" for k in range(50_000)])) for i in range(6)]
    start = time.monotonic()
    out = {r.doc_id: r for r in line_dedup.dedup_lines(make_docs(rows)).collect()}
    assert time.monotonic() - start < 60
    for i, text in rows:
        assert out[i].kept_text == (text if i == 5 else text.split("\n", 1)[1]) and out[i].n_lines == 50_001


def test_line_dedup_has_no_python(spark):
    plan = line_dedup.dedup_lines(spark.read.parquet(f"{SF_ORACLE}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow(Eval|Map)", plan)


# -- language -----------------------------------------------------------------
def test_forward_pass_sums_all_segmentations():
    pieces = language_id.Pieces(MULTI)
    rng = np.random.default_rng(0)
    prob = np.append(rng.random(len(pieces.tokens)), 0)[:, None]
    index = {t: k for k, t in enumerate(pieces.tokens)}

    def total(word):  # every cut into pieces, by recursion
        return 1.0 if not word else sum(prob[index[word[:n]], 0] * total(word[n:])
                                        for n in range(1, min(7, len(word)) + 1) if word[:n] in index)

    words = [b" the", b" thing", b"a", b" \xc3\xa9t\xc3\xa9", b" banana"]
    assert np.allclose(language_id.log_likelihood(pieces, prob, words)[:, 0], [np.log(total(w)) for w in words])
    long = b" " + b"abcdefgh" * 200
    assert np.isfinite(language_id.log_likelihood(pieces, prob / prob.sum(), [long])).all()


def test_every_piece_of_the_vocabulary_counts():
    with open(MULTI, "rb") as f:
        public = {base64.b64decode(line.split()[0]).lower() for line in f}
    pieces = language_id.Pieces(MULTI)
    assert public <= set(pieces.tokens)
    rng = np.random.default_rng(1)
    prob = np.append(rng.random(len(pieces.tokens)) / 100, 0)[:, None]
    index = {t: k for k, t in enumerate(pieces.tokens)}
    long = sorted((t for t in public if len(t) > 7 and t.strip(b" ").isalpha()), key=lambda t: (-len(t), t))
    words = [*long[:20], *long[-20:], *(b"x" + t + b"s" for t in long[:20]), " \u043d\u0435\u043a\u043e\u0442\u043e\u0440\u044b\u0435".encode()]

    def total(word):  # sums at each place, over the whole vocabulary
        sums = [1.0]
        for end in range(1, len(word) + 1):
            sums.append(sum(sums[a] * prob[index[word[a:end]], 0] for a in range(end) if word[a:end] in index))
        return sums[-1]

    assert np.allclose(language_id.log_likelihood(pieces, prob, words)[:, 0], [np.log(total(w)) for w in words])
    # by logs where the sums leave the range of a double
    word = b" " + long[0] * 40
    assert not language_id.in_range(prob, pieces, len(word))
    sums = [0.0]
    for end in range(1, len(word) + 1):
        sums.append(np.logaddexp.reduce([sums[a] + np.log(prob[index[word[a:end]], 0])
                                         for a in range(end) if word[a:end] in index]))
    assert np.allclose(language_id.log_likelihood(pieces, prob, [word]), sums[-1])


def test_long_words_teach(monkeypatch):
    pieces = language_id.Pieces(MULTI)
    run = " \u0e01\u0e32\u0e23\u0e40\u0e14\u0e34\u0e19\u0e17\u0e32\u0e07\u0e44\u0e1b\u0e15\u0e48\u0e32\u0e07\u0e1b\u0e23\u0e30\u0e40\u0e17\u0e28".encode()
    words = {run: 3, run * 20: 2, b" a": 5}
    prob = language_id.learn(pieces, words)
    nothing = language_id.learn(pieces, {b" a": 5})
    both = language_id.log_likelihood(pieces, np.stack([prob, nothing], axis=1), list(words))
    assert len(run) > 48 and (both[:2, 0] > both[:2, 1] + 50).all()
    monkeypatch.setattr(language_id, "in_range", lambda *_: False)  # the sums by logs are the same sums
    assert np.allclose(language_id.learn(pieces, words), prob, rtol=1e-9, atol=0)


def segmentations(word, index):
    """Every way to cut a word into pieces, as lists of piece numbers."""
    if not word:
        return [[]]
    return [[index[word[:k]], *rest] for k in range(1, len(word) + 1) if word[:k] in index for rest in segmentations(word[k:], index)]


def test_learning_by_enumerated_segmentations():
    pieces = language_id.Pieces(MULTI)
    index = {t: k for k, t in enumerate(pieces.tokens)}
    words = {b" the": 7, b" cat": 3, b" chat": 2, b" \xc3\xa9t\xc3\xa9": 1}
    sizes = np.array([len(t) for t in pieces.tokens])
    prob = 0.02 ** (sizes - 1.0) / 256
    prob = prob / prob.sum()
    for _ in range(4):  # expectation: each segmentation's share of its word's count, to each of its pieces
        expected = np.zeros(len(sizes))
        for word, count in words.items():
            every = segmentations(word, index)
            weight = np.array([np.prod(prob[s]) for s in every])
            for s, w in zip(every, weight / weight.sum()):
                for piece in s:
                    expected[piece] += count * w
        prob = expected + 0.05
        prob[sizes == 1] += 0.5
        prob /= prob.sum()
    assert np.allclose(language_id.learn(pieces, words)[:-1], prob, rtol=1e-9, atol=0)


def test_rows_are_the_posterior_of_the_fold_s_model(spark, make_docs):
    train = [(i, t, lang) for lang, base, t in (("en", 1000, "the cat sat"), ("fr", 2000, "le chat assis"), ("de", 3000, "die Katze"))
             for i in range(base, base + {"en": 60, "fr": 30, "de": 20}[lang])]
    rows = train + [(5000 + k, t, None) for k, t in enumerate(["the", "chat", "die cat", "x"])]
    docs = make_docs(rows)
    fold = {i: __import__("zlib").crc32(str(i).encode()) % 5 for i, *_ in rows}
    used = [(t, lang) for i, t, lang in train if fold[i]]
    langs = sorted({lang for _, lang in used})
    pieces = language_id.Pieces(MULTI)
    index = {t: k for k, t in enumerate(pieces.tokens)}
    model = []
    for lang in langs:
        counts = Counter(w for t, x in used if x == lang for w in language_id.words_of(t))
        model.append(language_id.learn(pieces, dict(counts)).astype(np.float32).astype(float))
    share = Counter(lang for _, lang in used)
    for r in language_id.identify(docs, MULTI).collect():
        text = dict((i, t) for i, t, _ in rows)[r.doc_id]
        logs = [np.log(share[lang] / len(used)) + sum(
            np.log(sum(np.prod(p[s]) for s in segmentations(w, index))) for w in language_id.words_of(text))
            for lang, p in zip(langs, model)]
        post = np.exp(logs - np.max(logs)) / np.exp(logs - np.max(logs)).sum()
        assert (r.held_out, r.lang_pred) == (fold[r.doc_id] == 0, langs[int(np.argmax(post))])
        assert r.score == pytest.approx(post.max(), rel=1e-6)


def test_stray_labels_do_not_grow_the_model(make_docs):
    docs = make_docs([(i, "the cat", "en") for i in range(9)] + [(100 + i, "le chat", "fr") for i in range(5)] + [(200 + i, "x", f"l{i}") for i in range(20)])
    names, prior, prob = language_id.fit(docs, MULTI, most_labels=2)
    assert names == ["en", "fr"] and prob.shape[1] == 2 and np.allclose(np.exp(prior), [9 / 14, 5 / 14])


def test_language_accuracy_and_held_out(spark):
    out = queries.op3_language_id(spark, SF_ORACLE).toPandas()
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "lang").toPandas()
    both = out.merge(docs)
    assert (both.held_out == [__import__("zlib").crc32(str(i).encode()) % 5 == 0 for i in both.doc_id]).all()
    held = both[both.held_out]
    assert (held.lang_pred == held.lang).mean() > 0.98
    assert out.score.between(0, 1).all() and len(out) == len(docs)


def test_language_of_odd_rows(make_docs, odd):
    train = make_docs([(300 + i, "the cat and the dog", "en") for i in range(20)] + [(100 + i, "le chat et le chien", "fr") for i in range(20)]
                      + [(200, "no label", None)])
    both = train.union(odd.select(train.columns))
    out = {}
    for r in language_id.identify(both, MULTI).collect():
        out.setdefault(r.doc_id, []).append((r.lang_pred, r.score))
    assert out[1] == out[2] == out[3] == [("und", 0.0)]
    assert len(out[4]) == 2 and out[5][0][0] in ("en", "fr") and out[None][0][0] in ("en", "fr")
    unlabelled = language_id.identify(odd.withColumn("lang", F.lit(None).cast("string")), MULTI).collect()
    assert {(r.lang_pred, r.score) for r in unlabelled} == {("und", 0.0)} and len(unlabelled) == len(ODD)
    assert language_id.identify(make_docs([]), MULTI).collect() == []


# -- quality ------------------------------------------------------------------
def test_pu_risk_separates_with_a_known_prior():
    rng = np.random.default_rng(1)
    pos, neg = rng.normal(2, 1, (2000, 3)), rng.normal(-2, 1, (400, 3))
    unl = np.concatenate([rng.normal(2, 1, (1600, 3)), neg])
    prior = quality.class_prior(pos, unl)
    assert abs(prior - 0.8) < 0.06
    net = quality.Network().train(pos, unl, prior)
    assert (net.value(pos) > 0).mean() > 0.95 and (net.value(neg) < 0).mean() > 0.8


def test_risk_and_gradient_by_finite_differences():
    rng = np.random.default_rng(2)
    seen = set()
    for trial in range(6):
        p, u = rng.normal(1, 1, (30, 4)), rng.normal(0 if trial % 2 else 3, 1, (50, 4))
        net, prior = quality.Network(hidden=5, seed=trial), [0.3, 0.95][trial % 2]
        net._start(np.concatenate([p, u]))
        net.w = [w + rng.normal(0, 0.5, w.shape) for w in net.w]

        def value(x):
            return np.tanh(x @ net.w[0] + net.w[1]) @ net.w[2] + net.w[3][0]

        if (value(p).mean() > value(u).mean()) != (trial % 2 == 1):  # odd trials: the unlabelled rows score below the positive ones
            net.w[2] = -net.w[2]
        net.w[2] = net.w[2] * 3

        def parts():  # written out: R_P(+), and R_U(-) less the prior's share of R_P(-)
            plus, minus = (lambda z: np.log1p(np.exp(-z))), (lambda z: np.log1p(np.exp(z)))
            return plus(value(p)).mean(), minus(value(u)).mean() - prior * minus(value(p)).mean()

        negative, grads = net.gradients(p, u, prior)
        assert negative == pytest.approx(parts()[1], rel=1e-9)
        seen.add(negative >= 0)
        aim = (lambda: prior * parts()[0] + parts()[1]) if negative >= 0 else (lambda: -parts()[1])
        for w, g in zip(net.w, grads):
            for at in list(np.ndindex(*w.shape))[:12]:
                keep, eps = w[at], 1e-6
                w[at] = keep + eps
                up = aim()
                w[at] = keep - eps
                down = aim()
                w[at] = keep
                assert g[at] == pytest.approx((up - down) / (2 * eps), rel=1e-4, abs=1e-7)
    assert seen == {True, False}  # both sides of the non-negative risk


def test_prior_bound_by_direct_count():
    rng = np.random.default_rng(4)
    for prior in (0.2, 0.5, 0.8):
        sp = rng.normal(2, 1, 800)
        su = np.concatenate([rng.normal(2, 1, int(1000 * prior)), rng.normal(-2, 1, int(1000 * (1 - prior)))])
        bounds = []
        for share in [k * 0.98 / 98 for k in range(99)]:
            cut = np.quantile(np.concatenate([sp, su]), share)
            a, b = sum(x >= cut for x in sp) / len(sp), sum(x >= cut for x in su) / len(su)
            if a >= 0.2:
                error = 0.5 * (max(b * (1 - b), 1e-9) / len(su)) ** 0.5 + 0.5 * (max(a * (1 - a), 1e-9) / len(sp)) ** 0.5
                bounds.append((b + error) / a)
        assert quality.prior_bound(sp, su) == pytest.approx(min(max(min(bounds), 0.02), 0.98), rel=1e-9)
        assert abs(quality.prior_bound(sp, su) - prior) < 0.06


def test_features_travel_as_bytes(spark, make_docs):
    rows = [(k, t) for k, t in enumerate(["", None, "A text, here\n" * 30, "é" * 5000, "1 2 3"])]
    got = quality.with_features(make_docs(rows), "doc_id", "text").collect()
    for r in got:
        assert np.array_equal(np.frombuffer(bytes(r.f), dtype="<f4"), quality.features(rows[r.doc_id][1]))
    x = quality.feature_rows([bytes(r.f) for r in got])
    assert x.shape == (5, quality.N_FEATURES) and np.array_equal(x, quality.feature_rows([bytes(r.f) for r in reversed(got)]))


def test_quality_held_out_accuracy(spark):
    out = queries.op6_quality(spark, SF_ORACLE).toPandas()
    labels = spark.read.parquet(f"{SF_ORACLE}/labels.parquet").select("doc_id", "quality").toPandas()
    held = out[out.held_out].merge(labels)
    good, bad = held[held.quality == 1], held[held.quality == 0]
    assert (good.predicted == 1).mean() > 0.95 and (bad.predicted == 0).mean() > 0.6
    assert (good.score.to_numpy()[:, None] > bad.score.to_numpy()[None, :]).mean() > 0.95
    assert ((out.score >= 0.5) == (out.predicted == 1)).all() and out.score.between(0, 1).all()


def test_quality_of_odd_rows(spark, odd, make_docs):
    labels = spark.createDataFrame([(6, 1, 0), (6, 1, 0), (7, 0, 1), (None, 1, 0), (8, None, None), (4, 1, 0)],
                                   "doc_id bigint, quality int, toxic int")
    out = quality.classify(odd, labels).collect()
    assert len(out) == len(ODD) and all(0 <= r.score <= 1 for r in out)
    assert len({r.score for r in out if r.doc_id in (1, 2)}) == 1  # null like empty
    none = quality.classify(odd, labels.where("quality = 0")).collect()
    assert {r.score for r in none} == {0.5}
    assert quality.classify(make_docs([]), labels).collect() == []


# -- PII ----------------------------------------------------------------------
def plain_spans(t):
    out = [(0, m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(1, m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m.group())
        if 13 <= len(d) <= 19 and pii.luhn(d):
            out.append((2, m.start(), m.end()))
    return sorted(out + [(3, m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t)
                         if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15])


def test_base_spans_are_the_patterns():
    rng = random.Random(4)
    parts = ["a", "b.c", "@", "@x.y", ".", "1", "12", "255", "256", "4111111111111111", " ", "-", "+1", "+1 (716) 555-8176",
             "(", ")", "é", "x@y.z-q.w", "1.2.3.4", "0001", "%", "_"]
    for _ in range(8000):
        t = "".join(rng.choice(parts) for _ in range(rng.choice([1, 3, 8, 20])))
        assert sorted(pii.base_spans(t)) == plain_spans(t)
    for slow in ("1" * 50_000, "a" * 50_000, "a@" * 20_000, "1." * 20_000, "+1 " * 20_000):
        pii.base_spans(slow)


def test_a_part_of_thousands_of_digits_is_read():
    text = "1." + "0" * 5000 + ".2.3 and 1." + "0" * 5000 + "256.2.3 and " + "7" * 6000 + ".1.2.3"
    assert pii.base_spans(text) == [(1, 0, 5006)]


def test_tagger_gradients():
    rng = np.random.default_rng(0)
    ids, tags = rng.integers(0, 90, (3, 9)).astype(np.int16), np.zeros((3, 9), dtype=np.int8)
    tags[0, 2:5], tags[1, 0:3] = (1, 2, 2), (7, 8, 8)
    tagger = pii.Tagger(4)

    def loss():
        emit, total = tagger.emissions(ids), 0.0
        a = np.where(tagger.banned, -1e9, tagger.p["A"])
        start = np.where((np.arange(9) > 0) & (np.arange(9) % 2 == 0), -1e9, tagger.p["S"])
        for n in range(3):
            now, gold = start + emit[0, n], start[tags[n, 0]] + emit[0, n, tags[n, 0]]
            for t in range(1, 9):
                now = np.logaddexp.reduce(now[:, None] + a, axis=0) + emit[t, n]
                gold += a[tags[n, t - 1], tags[n, t]] + emit[t, n, tags[n, t]]
            total += np.logaddexp.reduce(now) - gold
        return total / 3

    grads = tagger.loss_gradients(ids, tags)
    for name, at in {"Wf": (ids[0, 3], 5), "Wb": (ids[1, 1], 9), "Uf": (1, 7), "Ub": (2, 3), "V": (3, 4), "c": (1,), "A": (0, 1), "S": (7,)}.items():
        at, old = tuple(int(k) for k in at), tagger.p[name][tuple(int(k) for k in at)]
        values = []
        for e in (1e-5, -1e-5):
            tagger.p[name][at] = old + e
            values.append(loss())
        tagger.p[name][at] = old
        assert grads[name][at] == pytest.approx((values[0] - values[1]) / 2e-5, rel=1e-4, abs=1e-8)


def test_windows_are_reconciled():
    base = [(0, 10, 20)]
    found = [(3, 30, 40, 0.9), (3, 36, 50, 0.95),  # one span, cut by a window
             (1, 45, 48, 0.99),  # loses to the longer one
             (0, 15, 25, 0.99), (2, 60, 75, 0.9)]
    assert pii.reconcile(base, found) == [(0, 10, 20), (2, 60, 75), (3, 30, 50)]


@pytest.fixture(scope="module")
def tagger(spark):
    return pii.fit(spark.read.parquet(f"{SF_ORACLE}/documents.parquet"), steps=250)


def test_pii_rows(spark, tagger):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in pii.find(docs, tagger, pii.digest, pii.DIGEST).collect():
        spans = plain_spans(texts[r.doc_id])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == kind for k, _, _ in spans) for kind in range(4))
        text = pii.spell(spans)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert set(filter(None, text.split(","))) <= set(r.spans.split(","))


def test_the_model_finds_what_the_patterns_miss_and_leaves_clean_text_alone(spark, tagger):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("text").limit(400).collect()
    finder, rng = pii.Finder(tagger), np.random.default_rng(0)
    clean = [re.sub("[0-9@+]", "", r.text) for r in docs]
    assert not any(s for _, s in finder.spans(clean))
    hit = total = 0
    for text in [r.text for r in docs]:
        for kind, a, b in pii.base_spans(text):
            value = pii.rewrite(rng, kind, text[a:b])
            changed = text[max(0, a - 150):a] + value + text[b:b + 150]
            at = min(150, a)
            total += 1
            hit += any(k == kind and x <= at + 1 and y >= at + len(value) - 1 for k, x, y in finder.spans([changed])[0][1])
    assert total > 10 and hit / total > 0.6


def test_pii_of_odd_rows(odd, make_docs, tagger):
    out = pii.find(odd, tagger, pii.digest, pii.DIGEST).collect()
    assert len(out) == len(ODD) and {r.spans for r in out} == {""}
    assert pii.find(make_docs([]), tagger, pii.digest, pii.DIGEST).collect() == []
    assert pii.fit(make_docs([(1, "no signal")])) is None
    assert pii.find(make_docs([(1, "mail a.b@c.de")]), None, pii.redact, "t string").first().t == "mail [EMAIL]"


# -- Jaccard join -------------------------------------------------------------
def plain_components(rows, num=80, den=100):
    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()

    sets, parent = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if rows[a][0] is not None and rows[b][0] is not None and both and den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return Counter((i, len(sets[k]), None if i is None else least[find(k)]) for k, (i, _) in enumerate(rows))


@pytest.mark.parametrize("block", [1 << 20, 200])
def test_jaccard_components_equal_brute_force(make_docs, block):
    rng = random.Random(block)
    vocabulary = [f"w{k}" for k in range(400)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(30))
    rows = [r for r in ODD if r[0] != 5]
    for i in range(40):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([2, 5, 12, 60, 120]))]
        for _ in range(rng.choice([1, 1, 2, 6])):  # near copies, some edited at the threshold
            copy = list(words)
            for _ in range(rng.randint(0, 1 + len(words) // 40)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            text = " ".join(copy) + (" " + passage if rng.random() < 0.4 else "")
            rows.append((100 + len(rows), text.upper() if rng.random() < 0.1 else text))
    rows += [(7, "another text for an id that repeats, long enough to have shingles"), rows[-1]]
    got = Counter((r.doc_id, r.n_shingles, r.component_id)
                  for r in jaccard_join.near_duplicates(make_docs(rows, extra=True), block=block).collect())
    assert got == plain_components(rows)


def test_a_large_class_of_copies_is_dealt(make_docs):
    text = " ".join(f"w{k}" for k in range(40))
    rows = [(i, text) for i in range(5, 60)] + [(3, text + " tail"), (4, "alone"), (None, text), (9, None), (70, "alone")]
    got = Counter(tuple(r)[:3] for r in jaccard_join.near_duplicates(make_docs(rows, extra=True), deal=4).collect())
    whole = Counter(tuple(r)[:3] for r in jaccard_join.near_duplicates(make_docs(rows)).collect())
    assert got == whole and got[30, 36, 3] == 1 and got[70, 1, 4] == 1 and got[None, 36, None] == 1


def test_divide_skip_against_all_pairs():
    rng = np.random.default_rng(2)
    for _ in range(200):
        base = [np.unique(rng.integers(0, 300, rng.integers(1, 60))) for _ in range(3)]
        sets = [np.unique(np.where(rng.random(len(b)) < 0.08, rng.integers(0, 300, len(b)), b)).astype(np.uint64)
                for b in base for _ in range(rng.integers(1, 6))]
        sets.sort(key=len)
        linked = {(x, y) for x in range(len(sets)) for y in range(x + 1, len(sets))
                  if 100 * len(np.intersect1d(sets[x], sets[y])) >= 80 * len(np.union1d(sets[x], sets[y]))}
        found = jaccard_join.divide_skip(sets, 80, 100)
        assert set(found) <= linked

        def roots(edges):
            root = list(range(len(sets)))
            for a, b in edges:
                root = [root[a] if r == root[b] else r for r in root]
            return [root.index(r) for r in root]

        assert roots(found) == roots(linked)


def test_long_words_and_texts_in_pieces():
    shingler = jaccard_join.Shingler()
    text = " ".join(["word%d" % k for k in range(50)] + ["y" * 3000] + ["z%d" % k for k in range(50)])
    whole = shingler(text)
    old, jaccard_join._CHUNK = jaccard_join._CHUNK, 64
    try:
        assert (jaccard_join.Shingler()(text) == whole).all() and len(whole) == 97
    finally:
        jaccard_join._CHUNK = old


def test_list_lengths_count_a_hot_shingle_once_a_batch():
    rng = np.random.default_rng(6)
    hot = np.uint64(77 << 56)
    batches = [[np.unique(np.append(rng.integers(0, 1 << 63, 3).astype(np.uint64), hot)) for _ in range(size)] for size in (900, 1, 400)]
    by_bucket, entries = defaultdict(list), 0
    for sets in batches:
        for bucket, *packed in jaccard_join._count_batch(sets, 4):
            by_bucket[bucket].append(packed)
            entries += len(jaccard_join._unpack(packed[0]))
    top = np.uint64(64 - jaccard_join.FINGER)
    assert entries == sum(len(np.unique(np.concatenate(sets) >> top)) for sets in batches)  # repeats of a batch are one entry
    got = {}
    for bucket, rows in by_bucket.items():
        f, n = jaccard_join._add_batches(*zip(*rows))
        got.update(zip((f + np.uint64(bucket << (jaccard_join.FINGER - 4))).tolist(), n.tolist()))
    assert got == Counter((np.concatenate([s for sets in batches for s in sets]) >> top).tolist())


def test_blocks_of_a_hot_group_are_numbered_in_buckets(spark):
    rng = np.random.default_rng(7)
    rows = [(int(c), int(n), int(g)) for c, (n, g) in enumerate(zip(rng.choice([5, 5, 5, 9, 40], 600), rng.choice([1, 1, 1, 2], 600)))]
    found = spark.createDataFrame(rows, "c bigint, n bigint, g bigint")
    placed = jaccard_join._in_blocks(found, 100, deal=16)
    got = placed.select("c", "n", "g", "part").collect()
    assert sorted((r.c, r.n, r.g) for r in got) == rows
    for g in (1, 2):
        mine = sorted((r.n, r.part) for r in got if r.g == g)
        assert [p for _, p in mine] == sorted(p for _, p in mine)  # blocks ascend with the size
        held = Counter()
        for n, p in mine:
            held[p] += n
        assert max(held.values()) < 100 + 40 and len(held) >= sum(n for n, _ in mine) // 140
    plan = placed._jdf.queryExecution().optimizedPlan().toString()
    ranked = [line for line in plan.splitlines() if "row_number" in line and "Window [" in line]
    assert ranked and all("deal#" in line.split("windowspecdefinition(")[1].split("c#")[0] for line in ranked)


def test_jaccard_of_nothing(make_docs):
    assert jaccard_join.near_duplicates(make_docs([])).collect() == []


def test_jaccard_word_counts_and_posted_lists(spark, make_docs):
    """Long documents of common words that share a short passage are no candidates of each other."""
    rng = np.random.default_rng(5)
    common, rows = [f"of{k}" for k in range(4)], []
    for k in range(40):
        words = [common[rng.integers(4)] if rng.random() < 0.6 else f"w{k}x{j}" for j in range(400)]
        at = 10 * (k // 2)
        words[at:at + 10] = [f"passage{k // 2}y{j}" for j in range(10)]  # of two neighbours each
        rows.append((k, " ".join(words)))
    rows += [(100 + k, rows[k][1].replace("x399", "x39")) for k in range(3)]  # near copies of the first three
    docs = make_docs(rows).select(F.col("doc_id").alias("_id"), F.col("text").alias("_text")).repartition(3)
    lengths = jaccard_join.list_lengths(docs, 5, 16_000, 0)
    counts = Counter(int(s) for _, t in rows for s in jaccard_join._slot(jaccard_join.Shingler().of_words(t)))
    assert len(lengths[0]) == 0 and len(lengths[2]) == 1 << jaccard_join.SLOTS
    assert {k: int(lengths[2][k]) for k in counts} == {k: int(np.floor(8 * np.log2(n + 1))) for k, n in counts.items()}
    shingler = jaccard_join.Shingler()
    key = {jaccard_join.set_key(shingler(t)): i for i, t in rows}
    posted = jaccard_join.postings(docs, 5, 80, 100, lengths)
    edges = {frozenset((key[r.a], key[r.b])) for r in jaccard_join.chains(posted, 80, 100).collect()}
    assert edges == {frozenset((k, 100 + k)) for k in range(3)}


def test_jaccard_lists_that_go_on_over_batches():
    import pyarrow as pa
    rng = np.random.default_rng(6)
    rows = sorted({(int(h), int(c) % 60, int(c) % 7) for h, c in zip(rng.integers(0, 30, 400), rng.integers(0, 500, 400))} |
                  {(10, c, 0) for c in range(100, 180)}, key=lambda r: (r[0], r[2], r[1]))
    rows = sorted({(h, c): (h, c, c % 7) for h, c, _ in rows}.values(), key=lambda r: (r[0], r[2], r[1]))
    size = Counter(h for h, _, _ in rows)
    twice = [r for r in rows for _ in range(1 + r[1] % 2)]
    old, jaccard_join.LONG = jaccard_join.LONG, 20
    try:
        for step in (1, 7, 1000):
            batches = [pa.RecordBatch.from_arrays([pa.array([r[k] for r in twice[a:a + step]], t) for k, t in
                                                   enumerate((pa.int64(), pa.int64(), pa.int32()))], names=["h", "c", "n"])
                       for a in range(0, len(twice), step)]
            got = [tuple(r.values()) for b in jaccard_join._met([batches[0].slice(0, 0), *batches]) for r in b.to_pylist()]
            assert [r[:3] for r in got] == [r for r in rows if size[r[0]] > 1]
            assert all(m == min(20, size[h]) for h, _, _, m in got)
    finally:
        jaccard_join.LONG = old


def test_jaccard_bitmap_keeps_all_that_are_wanted(spark, make_docs):
    docs = make_docs([(k, "t") for k in range(500)]).select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
    kept = [r._id for r in jaccard_join._may_be(docs, docs.where("_id % 10 = 3").withColumnRenamed("_id", "_rep")).collect()]
    assert sorted(kept) == list(range(3, 500, 10))
    some = [r._id for r in jaccard_join._may_be(docs, docs.where("_id % 10 = 3").withColumnRenamed("_id", "_rep"), bits=7).collect()]
    assert set(kept) <= set(some) and len(some) == len(set(some))


def test_jaccard_leaves_no_shuffle_files_and_few_tables(spark, make_docs, tmp_path):
    text = " ".join(f"w{k}" for k in range(60))
    docs = make_docs([(1, text), (2, text + " tail"), (3, "other words"), (4, None)])
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        blocks = disk.getAllBlocks()
        return {b.toString() for b in (blocks.apply(k) for k in range(blocks.size())) if b.isShuffle()}

    before = shuffles()
    with session.scratch() as paths:
        found = jaccard_join.near_duplicates(docs)
        for _ in range(20):  # files go a moment later
            if not shuffles() - before:
                break
            time.sleep(0.5)
        assert not shuffles() - before
        assert len(paths) == 2  # sizes and components
        assert {r.doc_id: r.component_id for r in found.collect()} == {1: 1, 2: 1, 3: 3, 4: 4}
    session.drop_materialized(spark, paths)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) in (None, "false")

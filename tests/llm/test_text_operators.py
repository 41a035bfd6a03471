"""Quality, toxicity, archives, language model, rollups and mixing next to brute force."""

from __future__ import annotations

import base64
import hashlib
import io
import math
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlens import session
from flowlens.llm import bloom_lm, mixing, quality, rollups, toxicity, warc
from flowlens.llm.queries import ORACLES, QUERIES
from flowlens.session import new_path
from tests.llm.conftest import ROWS, find, lower
from tools.check_queries import compare, oracle_connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf, name):
    assert compare(spark, oracle_connection(sf), QUERIES[name], ORACLES[name], sf) is None


def counts(text):
    words, lines = find(text), [line for line in text.split("\n") if find(line)]
    grams = defaultdict(list)
    for k in range(len(words) - 4):
        grams[tuple(words[k:k + 5])].append(k)
    again = {k + j for at in grams.values() if len(at) > 1 for k in at for j in range(5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again))


def test_quality_counts(odd, none):
    got = Counter((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in quality.verdicts(odd).collect())
    assert got == Counter(counts(r[1] or "") for r in ROWS)
    assert quality.verdicts(none).count() == 0


def test_quality_limits_follow_the_group(spark):
    """The same symbol ratio is usual in one source and beyond the limit in the other."""
    plain = [(i, " ".join(f"w{i * j % 97}" for j in range(1, 60)), "en", "plain") for i in range(1, 200)]
    marked = [(1000 + i, " ".join(f"w{i * j % 97} |" for j in range(1, 40)), "en", "marked") for i in range(1, 200)]
    docs = spark.createDataFrame([*plain, *marked, (5000, marked[3][1], "en", "plain")], "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.kept for r in quality.verdicts(docs).collect()}
    assert not got.pop(5000) and sum(got.values()) > 0.98 * len(got)


def test_toxicity_on_held_out_texts(spark):
    rng = np.random.default_rng(5)
    def text(toxic):
        words = [f"w{k}" + "ab"[k % 2] * 3 for k in rng.zipf(1.5, 80) % 500]
        words = ["".join(chr(97 + int(c)) if c.isdigit() else c for c in w) for w in words]
        if toxic:
            words[int(rng.integers(80))] = rng.choice(["vileness", "grubby", "slimeball"])
            words[int(rng.integers(80))] = "nasty" + rng.choice(["er", "est", "ness", "ish"])
        return " ".join(words)
    rows = [(i, text(i % 8 == 0), int(i % 8 == 0)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(4)
    model = toxicity.fit(docs, docs.select("doc_id", "toxic"))
    scores = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    out = [(scores[i], t) for i, _, t in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([s >= 0.7 for s, t in out if t]) > 0.95 and np.mean([s >= 0.7 for s, t in out if not t]) < 0.01
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(s < 0.7 for s in scores.values())


def test_toxicity_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (5, 0), (None, 1), (10, None), (13, 1), (13, 0)], "doc_id long, toxic int")
    for some in (labels, labels.where("false")):
        model = toxicity.fit(odd, some)
        scores = [r.score for r in toxicity.score(odd, model).collect()]
        assert len(scores) == len(ROWS) and all(0 <= s <= 1 for s in scores)
        assert toxicity.score(none, model).count() == toxicity.drop_toxic(none, model).count() == 0
        assert toxicity.drop_toxic(odd, model).columns == odd.columns


def dense_training(positive, unlabelled, prior):
    """The estimator over 0/1 matrices, and its risk."""
    size = 1 << toxicity.DIM_BITS
    wide = [np.array([np.bincount(t, minlength=size).astype(np.int8) for t in texts]) for texts in (positive, unlabelled)]
    n_p, n_u = map(len, wide)
    in_p, in_u = (m.sum(axis=0, dtype=np.int64) for m in wide)
    usual = n_p * (in_u + 1) / n_u
    used = np.flatnonzero((in_p >= 3) & (in_p > usual + 4 * np.sqrt(usual) + 2) & (prior * in_p / n_p >= 0.3 * (in_u + 1) / n_u))
    x_p, x_u = (np.c_[m[:, used].astype(float), np.ones(len(m))] for m in wide)

    def loss(z, sign):
        return np.logaddexp(0, -sign * z).mean()

    def risk(theta):
        return prior * loss(x_p @ theta, 1) + max(0, loss(x_u @ theta, -1) - prior * loss(x_p @ theta, -1))

    theta = np.r_[np.zeros(len(used)), np.log(prior / (1 - prior))]
    start, m, v = risk(theta), 0, 0
    for step in range(1, toxicity.STEPS + 1):
        s_p, s_u = (1 / (1 + np.exp(-x @ theta)) for x in (x_p, x_u))
        clean = x_u.T @ s_u / n_u - prior * x_p.T @ s_p / n_p
        over = loss(x_u @ theta, -1) < prior * loss(x_p @ theta, -1)
        grad = -clean if over else prior * x_p.T @ (s_p - 1) / n_p + clean
        grad[:-1] += toxicity.DECAY * theta[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        theta = theta - toxicity.RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        theta[:-1] = np.maximum(theta[:-1], 0)
    return used, theta, start, risk(theta)


def test_toxicity_equals_dense_training(spark):
    rng = np.random.default_rng(8)
    words = ["".join(chr(97 + int(d)) for d in str(1000 + k)) for k in range(60)]
    texts = [(i, " ".join([*rng.choice(words, 12), *(["grubby"] * (i % 6 == 0)), *(["slimy"] * (i % 12 == 0))]), int(i % 6 == 0)) for i in range(300)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, toxic int")
    model = toxicity.fit(docs, docs.select("doc_id", "toxic"))
    learnt = [t for t in texts if zlib.crc32(str(t[0]).encode()) % 3 != 1]
    features = {i: toxicity.text_features(text) for i, text, _ in texts}
    prior = sum(t for _, _, t in learnt) / len(learnt)
    used, theta, start, end = dense_training([features[i] for i, _, t in learnt if t], [features[i] for i, _, _ in learnt], prior)
    assert len(used) and set(np.flatnonzero(model.weights)) <= set(used.tolist()) and end < start
    for r in toxicity.score(docs, model).collect():
        z = theta[:-1][np.isin(used, features[r.doc_id])].sum() + theta[-1]
        assert r.score == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-3)


PAGES = [(1, "http://a/ä b", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "u\r\nv", None), (4, "u", ""), (None, "u", "<p>x</p>"),
         (5, "u", "y" * 3_000_000), (6, "u", "\r\n\r\nWARC/1.1\r\n"), (6, "u", "\r\n\r\nWARC/1.1\r\n"), (None, "n", "only")]


def test_archives_give_pages_back(spark):
    pages = spark.createDataFrame([(*p, 0) for p in PAGES], "page_id long, url string, html string, refers_to int")
    first = {}
    for i, _, h in PAGES:
        first.setdefault(h or "", i)
    want = Counter()
    for i, _, h in PAGES:
        raw, to = (h or "").encode(), first[h or ""]
        want[(i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if to == i else "revisit",
              None if to == i else to)] += 1
    got = warc.read_archives(warc.write_archives(pages)).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    assert warc.read_archives(warc.write_archives(pages.where("false"))).count() == 0
    large = warc.read_archives(warc.write_archives(pages, least_bytes=10)).where("record_type = 'revisit'").collect()
    assert {r.page_id for r in large} == set()


def test_reader_finds_faults():
    one, two = warc.record(1, "u", b"abc" * 999), warc.record(2, "u", b"")
    assert [warc.parse(*r)["page_id"] for r in warc.read_records(io.BytesIO(one + two))] == ["1", "2"]
    plain = zlib.decompress(one, 31)

    def packed(data):
        c = zlib.compressobj(wbits=31)
        return c.compress(data) + c.flush()

    for bad in (one[:-20], packed(plain.replace(b"abc", b"abd", 1)), packed(plain + b"x"), packed(plain[:-2]), packed(plain * 2)):
        with pytest.raises((warc.Broken, zlib.error)):
            list(warc.read_records(io.BytesIO(bad)))


def test_language_model(documents, texts):
    model = bloom_lm.fit(documents)
    c = Counter()
    for i, text in texts.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            c.update(find(lower(text)) + [""])
    n, v = sum(c.values()), len(c)
    gain = Counter()
    for r in bloom_lm.score(documents, model).collect():
        words = find(lower(texts[r.doc_id])) + [""]
        out = zlib.crc32(str(r.doc_id).encode()) % 7 == 2
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(words), sum(c[w] > 0 for w in words), n, out)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words))
        gain[out] += r.score - r.base_score
    assert gain[True] > 0 and gain[False] > 0


def test_rare_words_go_through_the_join(documents, texts):
    """With a large share only some words are frequent; exact counts stay exact."""
    whole, split = (bloom_lm.score(documents, bloom_lm.fit(documents, share)) for share in (2.0 ** -20, 2.0 ** -9))
    both = whole.alias("a").join(split.alias("b"), "doc_id").where("abs(a.base_score - b.base_score) > 1e-6 or a.n_known <> b.n_known")
    assert both.count() == 0


def test_language_model_odd_rows(odd, none):
    for docs in (odd, none):
        rows = bloom_lm.score(odd, bloom_lm.fit(docs)).collect()
        assert len(rows) == len(ROWS) and all(r.score <= 1e-9 for r in rows)
    assert bloom_lm.score(none, bloom_lm.fit(odd)).count() == 0


def test_writes_let_go_of_their_shuffle_files(spark, tmp_path):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def left(write, seconds=0):
        before = {f.getName() for f in (disk.getAllFiles().apply(i) for i in range(disk.getAllFiles().size()))}
        write()
        until = time.monotonic() + seconds  # files go in the background
        while True:
            after = disk.getAllFiles()
            names = [n for n in (after.apply(i).getName() for i in range(after.size())) if n.endswith(".data") and n not in before]
            if not names or time.monotonic() >= until:
                return names
            time.sleep(0.2)

    dealt = spark.range(20000).repartition(3, "id")
    assert left(lambda: dealt.write.parquet(str(tmp_path / "kept")))
    with session.shuffles_freed(spark):
        assert not left(lambda: dealt.write.parquet(str(tmp_path / "freed")), seconds=10)
    assert spark.conf.get(session.FREE_SHUFFLES) == "false"
    assert spark.read.parquet(str(tmp_path / "freed")).count() == 20000



def test_filter_levels():
    keys = np.random.default_rng(2).integers(0, 1 << 62, 4000)
    counts = np.random.default_rng(3).zipf(1.3, 4000).clip(1, 10 ** 6)
    levels = bloom_lm.levels_of(counts)
    low = bloom_lm.LEAST_OF[levels - 1]
    assert (low <= counts).all() and (low[counts < 8] == counts[counts < 8]).all() and (counts < 1.2 * low + 1).all()
    bloom, any_level = bloom_lm.LogBloom(bloom_lm.LogBloom.build(keys, levels, bloom_lm.BITS)), np.full(4000, 999)
    found = bloom.levels(keys, any_level)
    assert (found >= levels).all() and (found == levels).mean() > 0.98
    assert (bloom.levels(keys + 1, any_level) == 0).mean() > 0.98
    assert (bloom.levels(keys, levels - 1) == levels - 1).all()


def changes(spark, rows):
    return spark.createDataFrame(rows, "op string, source string, lang string, tokenizer string, n_tokens long, "
                                       "old_source string, old_lang string, old_tokenizer string, old_tokens long")


def test_rollups(spark):
    folder = new_path(spark, "rollup-test")
    totals = rollups.Rollup(spark, folder)
    assert totals.totals().count() == 0
    load = changes(spark, [("insert", "a", "en", "v1", 10, None, None, None, None), ("insert", "a", "en", "v1", 5, None, None, None, None),
                           ("insert", None, None, "v1", None, None, None, None, None)])
    assert totals.commit("b/1", load) and not totals.commit("b/1", load)
    assert totals.commit("b2", changes(spark, [("revise", "a", "en", "v2", 7, "a", "en", "v1", 10)]))
    totals.compact()
    again = rollups.Rollup(spark, folder)  # another run
    assert not again.commit("b/1", load)
    assert again.commit("b3", changes(spark, [("delete", None, None, None, None, "a", "en", "v1", 5)]))
    assert again.commit("none", changes(spark, []))
    again.compact()
    assert {tuple(r) for r in again.totals().collect()} == {("a", "en", "v2", 1, 7), (None, None, "v1", 1, 0)}
    with pytest.raises(Exception, match="unknown operation"):
        again.commit("bad", changes(spark, [("merge", "a", "en", "v1", 1, None, None, None, None)]))


def water(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight, target = {s: k % 3 + 1 for k, s in enumerate(order)}, {}
    left, rest = set(order), sum(sizes.values())
    while left:
        share = {s: rest * weight[s] / sum(weight[x] for x in left) for s in left}
        over = [s for s in left if share[s] > 3 * sizes[s]]
        if not over:
            return {**target, **share}
        for s in over:
            target[s] = 3 * sizes[s]
            rest -= 3 * sizes[s]
            left.discard(s)
    return target


@pytest.mark.parametrize("sizes", [{"a": 5, "b": 7, None: 100}, {"a": 1000, "b": 1, "c": 2, "d": 0}, {"x": 4}, {"a": 0}, {"a": 0, None: 0}])
def test_targets(spark, sizes):
    got = mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, size long")).collect()
    assert {r.source: pytest.approx(r.target) for r in got} == water(sizes)


def test_mix_odd_rows(odd, none):
    rows = mixing.plan(odd).collect()
    assert len(rows) == len(ROWS) and all(r.taken == r.size * r.n_copies and r.n_copies <= 3 for r in rows)
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, mixing.plan(odd.repartition(5)).collect()), key=str)
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({k: v for k, v in sum(
        (Counter({r.doc_id: r.n_copies}) for r in rows), Counter()).items() if v})
    assert mixing.plan(none).count() == mixing.mix(none).count() == 0


@pytest.mark.parametrize("share", [1.0, 2.0 ** -9, 2.0 ** -30])
@pytest.mark.parametrize("bits", [64, bloom_lm.BITS])
def test_every_pair_counts_whatever_its_share(spark, documents, texts, share, bits, monkeypatch):
    """All pairs are read from the filter, whichever side of the share they are on; with many bits it takes no pair for another
    one, and scores equal those of the rounded counts; with few bits some pairs count too much, none too little."""
    monkeypatch.setattr(bloom_lm, "BUCKET", 30_000)  # many segments
    c, pairs = Counter(), Counter()
    for i, text in texts.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            words = find(lower(text)) + [""]
            c.update(words)
            pairs.update(zip(["", *words], words))
    n, v = sum(c.values()), len(c)
    rounded = {p: int(bloom_lm.LEAST_OF[bloom_lm.levels_of(np.array([m]))[0] - 1]) for p, m in pairs.items()}

    def wanted(text):
        words, total = find(lower(text)) + [""], 0.0
        for u, w in zip(["", *words], words):
            p = (c[w] + 1) / (n + v + 1)
            total += math.log10(0.95 * rounded.get((u, w), 0) / c[u] + 0.05 * p if c[u] else p)
        return total

    got = {r.doc_id: (r.score, r.n_tokens) for r in bloom_lm.score(documents, bloom_lm.fit(documents, share, bits)).collect()}
    assert len(got) == len(texts)
    above = np.array([score - wanted(texts[i]) for i, (score, _) in got.items()])
    sizes = np.array([size for _, size in got.values()])
    assert (above > -1e-5 * sizes).all()
    assert (above < 1e-5 * sizes).all() if bits == 64 else above.sum() < 0.002 * sizes.sum()

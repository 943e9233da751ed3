"""LM scoring: the baseline against exact counts, the filter against the counts put in, the model against chance."""

import math
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bantin.llm import language_model as L

DIR = "/root/testdata/sf0.01"


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def baseline(docs, learned):
    counts = Counter(w for (_, t), x in zip(docs, learned) if x for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    out = []
    for doc, text in docs:
        own = tokens(text)
        out.append((doc, len(own), sum(w in counts for w in own), n, sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)))
    return out


@pytest.mark.parametrize("max_words", [L.MAX_WORDS, 40])
def test_baseline_on_odd_rows(spark, max_words):
    docs = [(1, None), (2, ""), (3, "A a\tb\x0bB\x1cc É é"), (3, "A a\tb\x0bB\x1cc É é"), (4, "unseen words here"), (None, "a b"), (5, "w " * 3000), (6, " ".join(f"x{i}" for i in range(200)))]
    learned = [d != 4 for d, _ in docs]
    frame = spark.createDataFrame([(i, t, 9, "r") for i, t in docs], "doc_id long, text string, score long, row string").repartition(3)
    got = L.score(frame, F.coalesce(F.col("doc_id") != 4, F.lit(True)), max_words=max_words).collect()
    key = lambda r: repr(r[:4])
    want = sorted(baseline(docs, learned), key=key)
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=key)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    assert np.allclose([r[4] for r in got], [r[4] for r in want], rtol=1e-10)


def test_nothing_to_learn_from(spark):
    frame = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    rows = L.score(frame, F.lit(False)).collect()
    assert {(r.n_known, r.train_tokens, r.score) for r in rows} == {(0, 0, 0.0)}
    assert L.score(frame.limit(0), F.lit(True)).collect() == []


def test_filter_never_forgets(spark):
    texts = spark.createDataFrame([(f"a b c d{i % 7} a b" * (1 + i % 5),) for i in range(300)], "text string").repartition(3)
    _, frequent, model = L.train(texts)
    uni, bi = Counter(), Counter()
    for (t,) in texts.collect():
        own = [L.WORD_HASHES[w] if w else int(L.END) for w in tokens(t)]
        uni.update(own)
        bi.update(zip([int(L.END), *own], own))
    words = np.array(list(uni), np.uint64)
    assert (model.filter.levels(L._word_keys(words), np.full(len(words), 99)) >= L.level_of(np.array(list(uni.values())))).all()
    pairs = np.array(list(bi), np.uint64)
    levels = model.filter.levels(L._bigram_keys(pairs[:, 0], pairs[:, 1]), np.full(len(pairs), 99))
    assert (levels >= L.level_of(np.array(list(bi.values())))).all()
    assert np.mean(levels == L.level_of(np.array(list(bi.values())))) > 0.8
    strange = np.arange(10**6, 10**6 + 20_000, dtype=np.uint64)
    assert (model.filter.levels(L._word_keys(strange), np.full(20_000, 99)) > 0).mean() < 0.15


def test_levels():
    counts = np.arange(1, 5000)
    levels = L.level_of(counts)
    assert levels[0] == 1 and (np.diff(levels) >= 0).all() and L.level_of(np.array([0])) == 0
    assert (np.abs(np.log2(L._EXPECTED[levels] / counts)) <= 0.6).all()


def test_query(spark):
    rows = L.op1_lm_scoring(spark, DIR).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()]
    held = {d: zlib.crc32(str(d).encode()) % 5 == 1 for d, _ in docs}
    want = {r[0]: r for r in baseline(docs, [not held[d] for d, _ in docs])}
    for r in rows:
        assert r.held_out == held[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][1:4]
        assert math.isclose(r.base_score, want[r.doc_id][4], rel_tol=1e-9)
    apart = [r for r in rows if r.held_out]
    per_token = lambda c: sum(getattr(r, c) for r in apart) / sum(r.n_tokens for r in apart)
    assert per_token("score") > per_token("base_score")


def test_folding_keeps_all_and_probabilities_stay_below_one(spark):
    texts = spark.read.parquet(f"{DIR}/documents.parquet").select(F.coalesce("text", F.lit("")).alias("text")).limit(200)
    _, _, wide = L.train(texts)
    _, _, narrow = L.train(texts, max_bytes=20_000)
    assert len(narrow.filter.bits) <= 20_000 < len(wide.filter.bits) and narrow.filter.fill > wide.filter.fill
    own = np.concatenate([[L.END], L.WORD_HASHES.of(b"the of and ea th on".split())])
    assert (narrow.filter.levels(L._word_keys(own), np.full(len(own), 99)) >= wide.filter.levels(L._word_keys(own), np.full(len(own), 99)) - 2).all()
    assert (wide.log_probabilities(own) <= 0).all()


def test_scores_do_not_depend_on_the_size_of_a_part(spark, monkeypatch):
    frame = spark.read.parquet(f"{DIR}/documents.parquet").limit(300)
    learn = F.col("doc_id") % 3 != 0
    _, _, model = L.train(frame.where(learn).select(F.coalesce("text", F.lit("")).alias("text")))
    monkeypatch.setattr(L, "_CHUNK", 5_000)
    wide, narrow = ({r.doc_id: r.score for r in L.score(frame, learn, max_bytes=b).collect()} for b in (L.MAX_BYTES, 4_000))
    assert wide == narrow
    for r in frame.select("doc_id", "text").collect():
        own = np.array([L.WORD_HASHES[w] if w else int(L.END) for w in tokens(r.text)], np.uint64)
        assert math.isclose(model.log_probabilities(own).sum(), wide[r.doc_id], rel_tol=1e-9)


def test_no_room_for_frequent_words(spark):
    """More words in the topmost class of counts than may be broadcast: all are looked up by the join."""
    frame = spark.createDataFrame([(1, "a b"), (2, "c d")], "doc_id long, text string")
    few, many = (sorted((r.doc_id, round(r.base_score, 9)) for r in L.score(frame, F.lit(True), max_words=m).collect()) for m in (1, 1000))
    assert few == many


def witten_bell(docs, learned):
    """Scores from exact counts, of which only the quantising to levels is the filter's."""
    words, pairs = Counter(), Counter()
    for (_, text), x in zip(docs, learned):
        if x:
            own = tokens(text)
            words.update(own)
            pairs.update(zip([None, *own[:-1]], own))
    level = lambda c: int(L.level_of(np.array([c]))[0])
    kinds, events = Counter(), Counter()
    for (before, _), c in pairs.items():
        kinds[level(words[before])] += 1
        events[level(words[before])] += c
    ratio, last = {}, sum(kinds.values()) / max(1, sum(events.values()))
    for k in range(L._LEVELS + 1):
        ratio[k] = last = kinds[k] / events[k] if events[k] else last
    n, v = sum(words.values()), len(words)
    out = {}
    for doc, text in docs:
        own, total = tokens(text), 0.0
        for before, word in zip([None, *own[:-1]], own):
            lower = (L._EXPECTED[level(words[word])] + v / (v + 1)) / (n + v)
            seen = L._EXPECTED[level(words[before])]
            pair = min(L._EXPECTED[level(min(pairs[before, word], words[before], words[word]))], seen)
            more = seen * ratio[level(words[before])]
            total += math.log10((pair + more * lower) / (seen + more) if seen else lower)
        out[doc] = total
    return out


def test_scores_are_those_of_exact_counts(spark):
    """Only a hit the filter should not have had may make a probability larger, and that is rare."""
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(400)]
    docs = [(i, " ".join(rng.choice(vocabulary, size=rng.integers(0, 60), p=(lambda p: p / p.sum())(1 / np.arange(1, 401))))) for i in range(300)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.score for r in L.score(frame, F.col("doc_id") % 4 != 1).collect()}
    want = witten_bell(docs, [i % 4 != 1 for i, _ in docs])
    off = np.array([abs(got[i] - want[i]) / abs(want[i]) for i, _ in docs])
    assert (off < 1e-9).mean() > 0.5 and off.max() < 0.15 and abs(sum(got.values()) / sum(want.values()) - 1) < 0.01


def test_few_words_are_objects_at_once():
    texts = [" ".join(f"W{i % 1000}" for i in range(12_000)) for _ in range(60)] + ["", "one", " \n"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    tracemalloc.start()
    slices = [(rows["doc_id"].to_pylist(), hashes, sizes) for rows, hashes, sizes in L._slices(iter([batch]))]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [d for ids, _, _ in slices for d in ids] == list(range(len(texts)))
    sizes = np.concatenate([s for _, _, s in slices])
    assert sizes.tolist() == [len(t.split()) + 1 for t in texts]
    hashes = np.concatenate([h for _, h, _ in slices])
    assert (hashes[np.cumsum(sizes) - 1] == L.END).all()
    assert hashes[:12_000].tolist() == L.WORD_HASHES.of(texts[0].encode().lower().split()).tolist()
    # 8 bytes a token, twice while parts are joined; all words of a slice as objects were 13 times the text.
    assert peak < 6 * sum(map(len, texts))

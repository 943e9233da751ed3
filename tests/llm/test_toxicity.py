"""The toxicity models: probabilities, held-out accuracy, odd rows."""

import math
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from bantin.llm import toxicity as T


def corpus(seed, n=500):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices(["el", "ou", "ti", "an", "re", "sé", "mo"], k=rng.randrange(1, 5)))
    rows = []
    for i in range(n):
        words = [word() for _ in range(rng.randrange(5, 120))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(1 + len(words) // 20):
                words.insert(rng.randrange(len(words)), "zorg" + word())  # a stem in many forms
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_probabilities_sum_to_one():
    words = Counter("abba abc cab bab aab".split())
    letters = {x: 1 / 6 for x in "abc<>"}
    model = T._Class(words, 3, letters, 1 / 6)
    for context in ("", "a", "ab", "<a", "<", "bb", "zz"):
        total = sum(model.p(context + x) for x in "abc<>") + model.p(context + "?")
        assert math.isclose(total, 1.0, abs_tol=1e-9)


def test_model_is_its_classes_ratio():
    toxic, ordinary = Counter(["zorgel", "zorgan", "el"]), Counter(["el", "an", "anel"])
    model = T.Model(toxic, ordinary, order=3)
    model.dead_zone = 0.5
    letters = Counter()
    for words in (toxic, ordinary):
        letters.update({g: n for g, n in T._counts(words, 3).items() if len(g) == 1})
    total = sum(letters.values()) + 1
    a, b = (T._Class(w, 3, {x: n / total for x, n in letters.items()}, 1 / total) for w in (toxic, ordinary))
    for word in ("zorg", "elan", "qqq", "zorgel"):
        shown = "<" + word + ">"
        grams = [shown[max(0, e - 3) : e] for e in range(2, len(shown) + 1)]
        want = sum(math.log(a.p(g) / b.p(g)) for g in grams)
        got = model.word(word)
        assert math.isclose(got, math.copysign(max(0, abs(want) - 0.5), want), abs_tol=1e-9)


def test_held_out_accuracy_and_odd_rows(spark):
    rows = corpus(1) + [(5000, None, 0), (5001, "", 0), (5001, "", 0), (5002, "!!! 123", 1), (None, "zorgel zorgan", 1)]
    docs = spark.createDataFrame([(i, t, "a") for i, t, _ in rows], "doc_id long, text string, score string").repartition(3)
    labels = spark.createDataFrame([(i, x) for i, _, x in rows] + [(7, None), (8, 0), (8, 1), (None, 1), (9999, 1)], "doc_id long, toxic int")
    rated = T.toxicity(docs, labels, T._fold() != 0).select("row.doc_id", "row.score", F.col("score").alias("rate"), "text").collect()
    assert len(rated) == len(rows) and all(0 <= r.rate <= 1 for r in rated) and {r.score for r in rated} == {"a"}
    truth = {i: x for i, _, x in rows if i is not None and i < 5000}
    held = [r for r in rated if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(held) > 50 and sum((r.rate >= 0.5) == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    kept = T.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    left = {r.doc_id for r in kept.collect()}
    assert {5000, 5001} <= left and sum(i in left for i, x in truth.items() if not x) >= 0.99 * sum(1 - x for x in truth.values())
    assert sum(i in left for i, x in truth.items() if x) <= 0.03 * sum(truth.values())


def test_scores_are_those_of_plain_models(spark):
    """The whole score, from the sample on, by Kneser-Ney in its plain form and the fitted curve."""
    rows = corpus(3, 300)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, x) for i, _, x in rows], "doc_id long, toxic int")
    sample, share = T.labelled_sample(docs, labels, F.lit(True))
    assert sorted(sample) == sorted((x, t) for _, t, x in rows) and share == sum(x for _, _, x in rows) / len(rows)
    model = T.train(sample, share)
    learned = {k: [t for i, t in enumerate(t for x, t in sample if x == k) if i % 4 != 1] for k in (0, 1)}
    words = {k: Counter(w for t in learned[k] for w in t.lower().split()) for k in (0, 1)}
    letters = Counter()
    for k in (0, 1):
        letters.update({g: n for g, n in T._counts(words[k], T.ORDER).items() if len(g) == 1})
    total = sum(letters.values()) + 1
    plain = {k: T._Class(words[k], T.ORDER, {x: n / total for x, n in letters.items()}, 1 / total) for k in (0, 1)}

    def evidence(word):
        shown = f"<{word}>"
        ratio = sum(math.log(plain[1].p(g) / plain[0].p(g)) for g in (shown[max(0, e - T.ORDER) : e] for e in range(2, len(shown) + 1)))
        return math.copysign(max(0, abs(ratio) - model.dead_zone), ratio)

    assert model.dead_zone in T.DEAD_ZONES
    got = {r.doc_id: r.score for r in T.toxicity(docs, labels).select("row.doc_id", "score").collect()}
    for i, text, _ in rows[:40]:
        own = text.lower().split()
        mean, size = sum(map(evidence, own)) / len(own), math.log1p(len(own))
        z = model.curve @ [1, mean, size, mean * size]
        assert math.isclose(got[i], 1 / (1 + math.exp(-z)), rel_tol=1e-6, abs_tol=1e-9)


def test_one_label_on_very_many_texts(spark):
    """Rows that share a labelled id do not make the sample larger than asked for."""
    docs = spark.createDataFrame([(1, f"zorg{i} la") for i in range(500)] + [(i, f"el an{i}") for i in range(2, 50)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)] + [(i, 0) for i in range(2, 50)], "doc_id long, toxic int")
    sample, _ = T.labelled_sample(docs, labels, F.lit(True), sample_docs=20)
    assert Counter(x for x, _ in sample) == {0: 20, 1: 20}


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert {r.score for r in T.toxicity(docs, labels).collect()} == {0.0}
    assert T.toxicity(docs.limit(0), labels.limit(0)).collect() == []


@pytest.mark.parametrize("folder, worst", [("sf0.1", 0.06)])
def test_query_on_held_out_labels(spark, folder, worst):
    """The test labels carry noise: some five in a hundred toxic ones are on ordinary texts."""
    rated = T.op2_toxicity(spark, f"/root/testdata/{folder}")
    labels = spark.read.parquet(f"/root/testdata/{folder}/labels.parquet").select("doc_id", "toxic")
    n = {(r.toxic, r.predicted): r["count"] for r in rated.where("held_out").join(labels, "doc_id").groupBy("toxic", "predicted").count().collect()}
    wrong = n.get((0, 1), 0) + n.get((1, 0), 0)
    assert wrong <= worst * sum(n.values()) and n.get((0, 1), 0) <= 0.01 * (n[0, 0] + n.get((0, 1), 0))

"""Substring dedup against plain Python, by hashes that collide as well."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from bantin.llm import substring_dedup as S


def brute(docs, window):
    words = [re.findall("[^\x20\x09-\x0d]+", t or "") for _, t in docs]
    counts = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (doc, _), w in zip(docs, words):
        gone = set()
        for i in range(len(w) - window + 1):
            if counts[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((doc, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=repr)


def made(seed, n=60, vocabulary=400):
    rng = random.Random(seed)
    word = lambda: rng.choice("aébcdefgh") + str(rng.randrange(vocabulary))
    passages = [[word() for _ in range(rng.randrange(5, 60))] for _ in range(8)] + [["x", "y"] * 20, ["z"] * 30]
    docs = []
    for i in range(n):
        words = []
        for _ in range(rng.randrange(6)):
            passage = list(rng.choice(passages))
            if rng.random() < 0.4:
                passage[rng.randrange(len(passage))] = word()
            cut = sorted(rng.sample(range(len(passage) + 1), 2)) if rng.random() < 0.3 else (0, len(passage))
            words += [word() for _ in range(rng.randrange(8))] + passage[cut[0] : cut[1]]
        docs.append((i, "".join(w + rng.choice([" ", "\n", "\t\x0b "]) for w in words)))
    return docs + [(100 + i, docs[i][1]) for i in range(0, min(n, 20), 3)] + [(200, docs[1][1])] * 3


ODD = [(None, None), (None, ""), (1, "  \n"), (None, "a b c d e f g h i j"), (None, "a b c d e f g h i j"), (7, "one two three"), (7, "one two three")]
COLUMNS = ["doc_id", "n_words", "n_removed", "kept"]


@pytest.mark.parametrize("seed, window, anchor", [(1, 10, 4), (2, 12, 3), (3, 35, 8), (4, 5, 5), (5, 6, 1)])
def test_like_brute_force(spark, rows, seed, window, anchor):
    docs = made(seed) + ODD
    frame = spark.createDataFrame([(*d, "s", 1, 2) for d in docs], "doc_id long, text string, same string, anchor int, count int").repartition(6)
    found = S.remove_repeated_spans(frame, window, anchor)
    assert rows(found, *COLUMNS) == brute(docs, window)


def test_runs_are_those_removed(spark):
    docs = made(9)
    for r in S.remove_repeated_spans(spark.createDataFrame(docs, "doc_id long, text string"), 10, 4).collect():
        assert sum(x.b - x.a for x in r.removed) == r.n_removed and all(a.b < b.a for a, b in zip(r.removed, r.removed[1:]))


def test_paths_are_compacted(spark):
    """Three texts share a long passage and two of them what comes before it: two paths, not one per edge."""
    words = [f"w{i}" for i in range(3000)]
    texts = [words[:2000], ["own"] + words[:2000] + ["end"], ["other"] * 3 + words[1000:2000] + ["last"], words[2500:]]
    docs = [(i, " ".join(t)) for i, t in enumerate(texts)]
    found = S.repeated_paths(spark.createDataFrame(docs, "doc_id long, text string"), 35, 8).collect()
    spans = sorted(sorted((s.start, s.words) for s in r.spans) for r in found)
    assert spans == [[(0, 1034), (1000, 1000)], [(1, 1034), (1001, 1000)], [(3, 1000)]]
    assert len({s.path for r in found for s in r.spans}) == 2


def test_places_that_differ_are_found_out(spark, rows):
    """A path whose places hold different words, as after a collision: each window is compared."""

    docs = made(6, n=12, vocabulary=30)
    frame = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    window = 6
    texts = S._sources(frame)
    found = []
    for doc, text in docs:
        n = len((text or "").split())
        if n >= window:
            found.append((doc, [(0, n, 5)]))
    spans = spark.createDataFrame(found, "doc_id long, spans array<struct<start:long,words:long,path:long>>")
    spans = texts.join(spans, "doc_id").dropDuplicates(["same"]).select("same", "spans")
    wrong = spark.createDataFrame([(5,)], "path long")
    right = S._told_by_windows(texts, spans, wrong, window)
    assert rows(S._cut(texts.join(right, "same", "left")), *COLUMNS) == brute(docs, window)


def test_long_text_and_empty_table(spark, rows):
    assert S.remove_repeated_spans(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    long = " ".join(str(i) for i in range(300_000))
    docs = [(1, long), (2, "a " + " ".join(str(i) for i in range(1000, 1100)) + " b"), (3, "x" * 300_000)]
    assert rows(S.remove_repeated_spans(spark.createDataFrame(docs, "doc_id long, text string")), *COLUMNS) == brute(docs, S.WINDOW)


def test_parts_of_a_text_hold_each_edge_once(monkeypatch):
    hashes = np.random.default_rng(1).integers(0, 1 << 62, 1000).astype(np.uint64)
    monkeypatch.setattr(S, "_PART", 128)
    _, _, first, count = S.bundles(hashes, 35, 8)
    assert sorted(i for f, c in zip(first, count) for i in range(f, f + c)) == list(range(1000 - 34))

"""Suffix-array dedup against brute force over all windows."""

import random

import numpy as np
import pytest

from bantin.llm import suffix_dedup as S


def brute(docs, length):
    """Kept bytes per (doc_id, text) of distinct rows."""
    first, out = {}, {}
    low = lambda i: -(2**63) if i is None else i
    order = sorted({(low(i), (t or "").encode()) for i, t in docs})
    for i, t in order:
        for s in range(len(t) - length + 1):
            key = t[s : s + length]
            first[key] = min(first.get(key, (i, s)), (i, s))
    for i, t in order:
        gone = np.zeros(len(t), bool)
        for s in range(len(t) - length + 1):
            if first[t[s : s + length]] < (i, s):
                gone[s : s + length] = True
        runs = int((np.diff(np.concatenate([[False], gone]).astype(int)) == 1).sum())
        out[i, t] = (len(t), int(gone.sum()), runs, bytes(np.frombuffer(t, np.uint8)[~gone]))
    return out


def check(spark, docs, **options):
    frame = spark.createDataFrame([(i, t, 5, "x") for i, t in docs], "doc_id long, text string, first int, same string").repartition(5)
    length = options.get("length", S.LENGTH)
    want = brute(docs, length)
    low = lambda i: -(2**63) if i is None else i
    expected = sorted((i is None, i or 0, *want[low(i), (t or "").encode()]) for i, t in docs)
    got = S.remove_repeats(frame, **options).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in got) == expected


def texts(seed, n=60):
    rng = random.Random(seed)
    words = ["el", "ou", "tion", "é", "th", "日本", ".", "a" * 9]
    prose = lambda k: " ".join(rng.choices(words, k=k)) + str(rng.random())
    passages = [prose(rng.randrange(5, 60)) for _ in range(6)]
    docs = []
    for i in range(n):
        parts = [prose(rng.randrange(0, 40))]
        for _ in range(rng.randrange(3)):
            parts += [rng.choice(passages)[rng.randrange(20) :], prose(rng.randrange(0, 15))]
        docs.append((rng.randrange(1000) * 100 + i, "".join(parts)))
    return docs + [(999_999 + k, docs[0][1]) for k in range(4)] + [(5_000_000, docs[1][1][:-7] + "!"), (5_000_001, "ab" * 300)]


@pytest.mark.parametrize("seed", [1, 2])
def test_like_brute_force(spark, seed):
    check(spark, texts(seed) + [(None, None), (None, ""), (7, "short"), (7, "short"), (8, "y" * 99), (9, "y" * 100), (10, "y" * 101), (11, "z" * 500)])


def test_short_strings_and_hot_anchors(spark, monkeypatch):
    monkeypatch.setattr(S, "HOT_STRETCHES", 3)
    check(spark, texts(3, 40), length=30, anchor=11)


def test_long_texts_in_parts(spark, monkeypatch):
    monkeypatch.setattr(S, "_PART", 150)
    check(spark, texts(4, 30))


def test_empty_table(spark):
    assert S.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_suffix_array():
    rng = random.Random(5)
    for _ in range(200):
        text = bytes(rng.choices(b"\0abc", k=rng.randrange(30))) + b"\0"
        assert S.suffix_array(text, 40) == sorted(range(len(text)), key=lambda i: text[i:])


@pytest.mark.parametrize("hot", [S.HOT_STRETCHES, 3])
def test_texts_that_share_an_id(spark, monkeypatch, hot):
    monkeypatch.setattr(S, "HOT_STRETCHES", hot)
    some = [(None if i % 3 == 0 else i % 2, t) for i, (_, t) in enumerate(texts(6, 45))]
    shared = "".join(random.Random(7).choices("abcdefgh ", k=400))
    check(spark, some + [(None, shared), (None, "x" + shared[:300] + "tail"), (None, shared[150:] + "y"), (4, shared[:250]), (4, "zz" + shared[40:]), (4, shared[:260] + "!")])

"""The Jaccard join against all pairs, on random near copies and odd rows."""

import random

import numpy as np
import pytest

from bantin.llm import jaccard_join as J
from bantin.llm.components import connected_components


def sets_of(docs, n):
    out = []
    for _, text in docs:
        words = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
        k = min(n, len(words))
        out.append({tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set())
    return out


def brute(docs, n, percent):
    sets = sets_of(docs, n)
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    ids = {}
    for i, (doc, _) in enumerate(docs):
        if doc is not None:
            ids[find(i)] = min(ids.get(find(i), doc), doc)
    return sorted(((doc, len(s), ids.get(find(i)) if s else doc) for i, ((doc, _), s) in enumerate(zip(docs, sets))), key=repr)


def near_copies(seed, groups, size):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=3))
    docs = []
    for _ in range(groups):
        base = [word() for _ in range(rng.choice([1, 2, 3, 4, 6, 9, 10, 11, 12, 20, 30, 60, 150, 400]))]
        for _ in range(rng.randrange(1, size)):
            copy = list(base)
            for _ in range(rng.randrange(0, 1 + max(2, len(base) // 18))):
                at = rng.randrange(len(copy))
                copy[at : at + rng.randrange(2)] = [word()] * rng.randrange(3) or [word()]
            docs.append((rng.randrange(10**6), " ".join(copy)))
    return docs


ODD = [(7, None), (8, ""), (9, " \n\t"), (10, "Uno DUE"), (11, "uno due"), (12, "x"), (12, "x"), (None, "uno due"), (None, None), (13, "é b c d e"), (14, "only"), (None, "alone here now")]


@pytest.mark.parametrize("words, percent, seed", [(3, 90, 1), (5, 80, 2), (1, 80, 3), (3, 90, 4)])
def test_like_all_pairs(spark, rows, words, percent, seed):
    docs = near_copies(seed, 60, 9) + ODD
    frame = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, same long, n long").repartition(4)
    assert rows(J.near_duplicates(frame, words, percent)) == brute(docs, words, percent)


def test_large_group_in_blocks(spark, rows, monkeypatch):
    monkeypatch.setattr(J, "BLOCK", 16)
    rng = random.Random(9)
    base = ["".join(rng.choices("abcdefgh", k=4)) for _ in range(100)]
    docs = []
    for i in range(150):  # each differs from the base in two or three places: some link only to some
        copy = list(base)
        for at in rng.sample(range(100), rng.choice([1, 2, 3])):
            copy[at] = f"new{rng.randrange(40)}"
        docs.append((i, " ".join(copy)))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert rows(J.near_duplicates(frame)) == brute(docs, 3, 90)


def test_few_rows_and_arrays(spark, rows, monkeypatch):
    rng = random.Random(11)
    text = lambda k: ["".join(rng.choices("abcdefgh", k=4)) for _ in range(k)]
    docs, close = [], []
    for g in range(12):  # two near copies; two texts that share half their words, so some tiles, and are not similar
        base, half = text(400), text(200)
        close += [(10 * g, " ".join(base)), (10 * g + 1, " ".join([*base, "more"]))]
        docs += [(10 * g + 2, " ".join(half + text(200))), (10 * g + 3, " ".join(half + text(200)))]
    kept, plain = [], J.stored

    def stored(df, *args):
        out = plain(df, *args)
        kept.append((out.columns, out.count()))
        return out

    monkeypatch.setattr(J, "stored", stored)
    frame = spark.createDataFrame(close + docs, "doc_id long, text string").repartition(4)
    assert rows(J.near_duplicates(frame)) == brute(close + docs, 3, 90)
    # Tiles of the same members are one, and only texts that bitmaps do not part have their arrays stored.
    assert max(n for columns, n in kept if "tile" in columns) <= 2 * len(close + docs)
    assert sum(n for columns, n in kept if "hashes" in columns) == len(close)


@pytest.mark.parametrize("bits", [10, 28])
def test_full_filter(spark, rows, monkeypatch, bits):
    monkeypatch.setattr(J, "TILE_BITS", bits)
    docs = near_copies(12, 40, 7) + ODD
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert rows(J.near_duplicates(frame, 5, 80)) == brute(docs, 5, 80)


def test_segments_leave_one_equal():
    rng = np.random.default_rng(0)
    for percent in (80, 90, 95):
        bands = J.Bands(percent)
        for size in (1, 2, 5, 9, 10, 11, 19, 20, 33, 100, 300):
            for _ in range(40):
                x = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
                most = (100 - percent) * len(x) // 100
                y = np.unique(np.concatenate([x[rng.permutation(len(x))[: len(x) - rng.integers(0, most + 1)]], rng.integers(0, 2**64, rng.integers(0, 2), dtype=np.uint64)]))
                both = len(np.intersect1d(x, y))
                if both and 100 * both >= percent * (len(x) + len(y) - both):
                    assert len(np.intersect1d(bands.tiles(x), bands.tiles(y)))


def test_bitmaps_bound_the_difference():
    rng = np.random.default_rng(1)
    for a, b in ((10, 12), (100, 90), (1000, 1100), (500, 530)):
        x = np.unique(rng.integers(0, 2**64, a, dtype=np.uint64))
        y = np.unique(np.concatenate([x[: a // 2], rng.integers(0, 2**64, b - a // 2, dtype=np.uint64)]))
        p, q = J._folded([J.bitmap(x), J.bitmap(y)])
        assert np.bitwise_count(p ^ q).sum() <= len(x) + len(y) - 2 * len(np.intersect1d(x, y))


def test_drop_near_duplicates(spark):
    docs = near_copies(5, 20, 5) + ODD + [(10, "a wholly different text of the same id")]
    frame = spark.createDataFrame([(i, t, "s") for i, t in docs], "doc_id long, text string, _gone string")
    first = {(i, c) for i, _, c in brute(docs, 5, 80) if i == c}
    kept = J.drop_near_duplicates(frame)
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in first}


def test_empty(spark):
    assert J.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(200, 260)] + [(5, 5), (-3, -9), (-9, -3)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, **{i: 100 for i in range(200, 260)}, -3: -9, -9: -9}

"""Collocations against plain Python, filters against dictionaries."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from bantin.llm import collocations as C

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def brute(docs, min_count=10, covered=50, top=2000):
    counts, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in (1, 2, 3):
                counts.update((lang, *words[i : i + size]) for i in range(len(words) - size + 1))
    often = {p: f for p, f in counts.items() if len(p) > 2 and f >= min_count}
    gone = {s for p, f in often.items() if len(p) == 4 for s in ((p[0], *p[1:3]), (p[0], *p[2:4])) if s in often and 100 * f >= covered * often[s]}
    ranked = {}
    for p, a in often.items():
        if p not in gone:
            cuts = []
            for k in range(1, len(p) - 1):
                l, r = counts[p[: k + 1]], counts[(p[0], *p[k + 1 :])]  # noqa: E741
                cuts.append((1_000_000 * a * a // (l * r), k, l, r))
            score, _, l, r = min(cuts)  # noqa: E741
            ranked.setdefault(p[0], []).append((-score, -a, " ".join(p[1:]).encode(), l, r))
    out = []
    for lang, found in ranked.items():
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):  # noqa: E741
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out, key=repr)


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def made(seed, n=150):
    rng = random.Random(seed)
    words = ["alpha", "Beta", "gamma", "é", "ünïcode", "x\x00y", "of", "the", "end\x0bline", "z z"]
    docs = []
    for _ in range(n):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ", ", ".", "\n", "?! "]) for _ in range(rng.randrange(60)))
        docs.append((rng.choice(["en", "de", None, "und", ""]), text))
    return docs


@pytest.mark.parametrize("chunk, shard", [(C.CHUNK, C.SHARD), (200, 50)])
def test_like_brute_force(spark, rows, chunk, shard):
    docs = made(4) + [("en", None), ("en", ""), ("en", "..,,\n"), ("en", "a")] + [("fr", "la même phrase")] * 10 + [("fr", "la même")] * 9
    frame = spark.createDataFrame([(*d, 1, "q") for d in docs], "lang string, text string, n int, word string").repartition(7)
    assert rows(C.collocations(frame, chunk=chunk, shard=shard), *COLUMNS) == brute(docs)
    assert rows(C.collocations(frame, min_count=3, covered_percent=80, top=5, chunk=chunk, shard=shard), *COLUMNS) == brute(docs, 3, 80, 5)


def test_long_text_goes_in_parts(spark, rows):
    rng = random.Random(2)
    docs = [("en", "".join(rng.choice(["a", "b", "c", "dd"]) + rng.choice([" ", " ", " ", ","]) for _ in range(3000))), ("en", "w" * 5000)]
    found = C.collocations(spark.createDataFrame(docs, "lang string, text string"), chunk=100)
    assert rows(found, *COLUMNS) == brute(docs)


def test_slices_join_again(monkeypatch):
    monkeypatch.setattr(C, "_SLICE_BYTES", 30)
    text = b"some words, and more. " * 40 + b"x" * 100 + b" end"
    assert b"".join(C._slices(text)) == text and len(list(C._slices(text))) > 20


@pytest.mark.parametrize("docs", [[], [("en", None)], [(None, "once only")]])
def test_nothing_to_find(spark, docs):
    assert C.collocations(spark.createDataFrame(docs, "lang string, text string")).collect() == []


@pytest.mark.parametrize("bits", [2, 5, 20, 21, 22, 33, 42])
def test_packing_is_a_bijection(bits):
    rng = np.random.default_rng(bits)
    for order in (2, 3):
        packing = C.Packing(order, bits)
        ids = [rng.integers(0, 1 << bits, 500).astype(np.uint64) for _ in range(order)]
        high, low = packing.permute(*packing.pack(ids))
        assert int(max(high.max(), low.max())) < 1 << packing.half
        assert all((a == b).all() for a, b in zip(packing.unpack(*packing.restore(high, low)), ids))


@pytest.mark.parametrize("half", [3, 20, 31, 33, 45, 63, 64])
def test_filters_keep_and_merge_all(half):
    rng = np.random.default_rng(half)
    total, parts = Counter(), []
    for _ in range(4):
        values = rng.integers(0, 1 << min(half, 62), (2, 400)).astype(np.uint64)
        values[:, :100] = values[:, :1]
        if half == 3:
            values = values[:, :300]
        high, low, counts = C.summed(*values, None, half)
        total.update(dict(zip(zip(high.tolist(), low.tolist()), (counts * 3).tolist())))
        known = 1
        shards = high >> np.uint64(half - known)
        for s in (0, 1):
            part = shards == s
            if part.any():
                data = C.write_filter(high[part], low[part], counts[part] * 3, half, known)
                back = C.read_filter(data, half, known, s)
                assert all((a == b).all() for a, b in zip(back, (high[part], low[part], counts[part] * 3)))
                parts.append(back)
    high, low, counts = C.summed(*(np.concatenate(x) for x in zip(*parts)), half)
    assert dict(zip(zip(high.tolist(), low.tolist()), counts.tolist())) == total


def test_more_than_128_bits_is_refused():
    with pytest.raises(ValueError):
        C.Packing(3, 43)

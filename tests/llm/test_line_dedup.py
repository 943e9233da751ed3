"""Line dedup against plain Python, with filters of any size."""

import random

import numpy as np
import pytest

from bantin.llm import line_dedup as L
from bantin.llm.seen_twice import seen_twice

SPACE = " \t\n\x0b\x0c\r"


def key_of(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def brute(docs, min_chars=20, min_docs=3):
    held = {}
    low = lambda i: -(2**63) if i is None else i
    for doc, text in docs:
        for line in (text or "").split("\n"):
            if len(key_of(line)) >= min_chars:
                held.setdefault(key_of(line), set()).add(low(doc))
    out = []
    for doc, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(held.get(key_of(x), ())) < min_docs or max(held[key_of(x)]) == low(doc)]
        out.append((doc, "\n".join(kept) if text is not None or len(kept) < len(lines) else None, len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def made(seed):
    rng = random.Random(seed)
    lines = [f"shared line number {i} of the corpus é" for i in range(12)] + ["exactly twenty chars", "é" * 19, "short", "", "   "]
    docs = []
    for i in range(80):
        parts = [rng.choice(["", " ", "\t", "\x0b"]) + (x.upper() if rng.random() < 0.2 and x.isascii() else x) for x in rng.choices(lines, k=rng.randrange(1, 6))]
        docs.append((rng.randrange(10_000), "\n".join(parts + [f"own line of document {i}, once"])))
    return docs


ODD = [(1, None), (2, ""), (3, "\n\n"), (None, "shared line number 1 of the corpus é"), (None, "exactly twenty chars"), (5, "exactly twenty chars"), (5, "exactly twenty chars"), (6, "z" * 200_000)]


@pytest.mark.parametrize("bits", [27, 14, 3])
def test_like_brute_force(spark, rows, bits):
    docs = made(bits) + ODD
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, keys int, _id string").repartition(5)
    cut = L.without_shared_lines(frame, bits_log2=bits)
    assert rows(cut, "row.doc_id", "text", "n_lines", "n_dropped") == brute(docs)
    left = L.dedup_lines(frame, bits_log2=bits)
    assert left.columns == frame.columns and left.count() == len(docs)


def test_empty_table(spark):
    assert L.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_seen_twice_knows_all_repeated(spark):
    rng = np.random.default_rng(0)
    once, twice = rng.integers(1, 2**62, 3000), rng.integers(1, 2**62, 500)
    values = np.concatenate([once, twice, twice]).tolist()
    frame = spark.createDataFrame([(v,) for v in values], "h long").repartition(7)
    found = seen_twice(frame, lambda b: b["h"].to_numpy().view(np.uint64), bits_log2=18)
    assert found.has(twice.view(np.uint64)).all() and found.has(once.view(np.uint64)).mean() < 0.02

"""Benchmark decontamination against plain Python."""

import hashlib
import re

import pytest

from bantin.llm import decontamination as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, n=10):
    windows = {}
    for item, text in items:
        words = words_of(text)
        k = min(n, len(words))
        for i in range(len(words) - k + 1) if k else ():
            windows.setdefault(tuple(words[i : i + k]), set()).add(item)
    out = []
    for doc, text in docs:
        words, hit, found = words_of(text), set(), set()
        for window, owners in windows.items():
            for i in range(len(words) - len(window) + 1):
                if tuple(words[i : i + len(window)]) == window:
                    hit.update(range(i, i + len(window)))
                    found |= owners
        names = ",".join(sorted(str(i) for i in found if i is not None))
        n_items = len(found - {None})
        out.append((doc, len(words), len(hit), n_items, hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


LONG = "The quick brown fox, jumps over the lazy dog; and then it sleeps for 12 hours près du café"
ITEMS = [(1, LONG), (2, "Short item"), (10, "é"), (3, None), (4, ""), (5, "..."), (None, "no id here"), (6, LONG), (6, LONG), (7, "w " * 30)]
DOCS = [
    (1, f"Before {LONG.upper()} after"), (2, "the QUICK brown-fox jumps over the lazy dog and then!"), (3, "the quick brown fox jumps over the lazy dog and"),
    (4, None), (5, ""), (6, "a short\nITEM short item"), (7, "É é e"), (7, "É é e"), (None, "short item"), (8, "no id here"), (9, "w " * 45), (10, "x" * 50_000), (11, "shortitem"),
]


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.createDataFrame([(i, t, "r", 3) for i, t in DOCS], "doc_id long, text string, row string, n_words int").repartition(3)
    return docs, spark.createDataFrame(ITEMS, "item_id long, text string")


@pytest.mark.parametrize("max_windows", [D.MAX_WINDOWS, 5])
def test_report(tables, rows, max_windows):
    docs, items = tables
    assert rows(D.contamination_report(docs, items, max_windows=max_windows)) == brute(DOCS, ITEMS)


def test_remove_documents_and_spans(tables):
    docs, items = tables
    clean = [r[0] for r in brute(DOCS, ITEMS) if not r[5]]
    left = D.decontaminate(docs, items)
    assert left.columns == docs.columns
    assert sorted((r.doc_id for r in left.collect()), key=repr) == sorted(clean, key=repr)
    cut = {(r.doc_id, r.text) for r in D.decontaminate(docs, items, remove="spans").collect()}
    assert (1, "Before  PRÈS DU CAFÉ after") in cut and (4, None) in cut and (6, "a ") in cut and (11, "shortitem") in cut
    with pytest.raises(ValueError):
        D.decontaminate(docs, items, remove="words")


def test_empty_tables(spark, tables, rows):
    docs, items = tables
    assert D.contamination_report(docs.limit(0), items).collect() == []
    assert rows(D.contamination_report(docs, items.limit(0))) == brute(DOCS, [])

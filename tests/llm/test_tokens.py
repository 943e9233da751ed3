"""Token ids, packing and token files against the tokenizer itself and plain Python."""

import tracemalloc
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from bantin.llm.packing import pack, plan, sequences
from bantin.llm.token_files import lookup, read_token_files, write_token_files
from bantin.llm.tokenise import Encoder, default_tokenizer, encoder

TEXTS = [
    "Hello, WORLD!! don't stop... it's 42% of 3,000", None, "", "   \n\t ", "x" * 30_000, "a b " * 9_000,
    "Ünïcode ΑΣ. \u0085 thin space é \x1c odd", "<|endoftext|> and <|StartOfText|>", "Hello, WORLD!!", "Hello, WORLD!!",
    "İstanbul,ok;; a.b.c 'S 'll", "日本語。テキスト　全角",
]
DOCS = [(i * 3, t) for i, t in enumerate(TEXTS)] + [(3, None), (None, "no id"), (None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, 7, "piece") for i, t in DOCS]
    return spark.createDataFrame(rows, "doc_id long, text string, length int, start string").repartition(3)


@pytest.fixture(scope="module")
def whole():
    tokenizer = Tokenizer.from_file(default_tokenizer())
    return lambda t: tokenizer.encode(t or "", add_special_tokens=False).ids


def test_word_by_word_is_the_whole_text(whole):
    got = encoder(default_tokenizer()).encode([(t or "").encode() for t in TEXTS])
    assert [x.tolist() for x in got] == [whole(t) for t in TEXTS]


def test_plan_is_best_fit_decreasing():
    rng = np.random.default_rng(0)
    for capacity in (1, 7, 50):
        lengths = rng.integers(1, capacity + 1, 300).tolist()
        rooms = []
        for n in sorted(lengths, reverse=True):
            fit = [r for r in rooms if r >= n]
            if fit:
                rooms.remove(min(fit))
                rooms.append(min(fit) - n)
            else:
                rooms.append(capacity - n)
        histogram = {n: lengths.count(n) for n in set(lengths)}
        used = {}
        for n, first_rank, count, first, each, offset in plan(histogram, capacity):
            for i in range(count):
                used.setdefault(first + i // each, []).append((offset + i % each * n, n))
        assert len(used) == len(rooms)
        for parts in used.values():
            at = 0
            for offset, n in sorted(parts):
                assert offset == at
                at += n
            assert at <= capacity
    assert plan({}) == []


def test_plan_stays_small():
    rng = np.random.default_rng(1)
    histogram = {int(n): int(c) for n, c in zip(range(1, 4097), rng.integers(1, 10**9, 4096))}
    assert len(plan(histogram)) < 150_000


def test_pack(spark, docs, whole):
    rows = pack(docs, with_ids=True).collect()
    want = []
    for doc, text in DOCS:
        ids = whole(text) + [1]
        for k in range(0, len(ids), 4096):
            part = np.array(ids[k : k + 4096], "<u4").tobytes()
            want.append((doc, k // 4096, k, len(part) // 4, zlib.crc32(part)))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=key) == sorted(want, key=key)
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in places.values():
        ends = [0] + [a + n for a, n in sorted(parts)]
        assert [a for a, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 4096
    total = sum(r.length for r in rows)
    assert len(places) <= -(-total // 4096) + 1
    made = {r.sequence_id: r for r in sequences(pack(docs, with_ids=True)).collect()}
    assert sum(len(r.ids) for r in made.values()) == 4 * total
    empty = pack(spark.createDataFrame([], docs.schema))
    assert empty.collect() == [] and "sequence_id" in empty.columns


def test_hot_length_is_dealt_over_buckets(spark, monkeypatch):
    monkeypatch.setattr("bantin.llm.packing._PER_BUCKET", 50)
    rows = pack(spark.range(1000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'a', concat_ws(' ', sequence(0, id % 50))) AS text")).collect()
    assert len({(r.sequence_id, r.offset) for r in rows}) == 1000
    assert len({r.sequence_id for r in rows}) == -(-sum(r.length for r in rows) // 4096)


def test_token_files(spark, docs, whole, tmp_path):
    folder = f"file://{tmp_path}/ids"
    write_token_files(docs, folder, file_bytes=100)
    rows = sorted(read_token_files(spark, folder).collect(), key=lambda r: r.start)
    known = [(r.doc_id is not None, r.doc_id or 0) for r in rows]
    assert known == sorted(known) and len(rows) == len(DOCS)
    assert [r.start for r in rows] == np.cumsum([0] + [r.n_tokens for r in rows])[:-1].tolist()
    for r in rows:
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.n_tokens
    want = sorted(((i, whole(t) + [2]) for i, t in DOCS), key=repr)
    assert sorted(((r.doc_id, r.ids) for r in rows), key=repr) == want
    found = lookup(spark, folder, spark.createDataFrame([(0,), (6,), (99,)], "doc_id long")).collect()
    assert sorted((r.doc_id, r.ids) for r in found) == [(0, whole(TEXTS[0]) + [2]), (6, [2])]
    write_token_files(spark.createDataFrame([], docs.schema), folder + "-empty")
    assert read_token_files(spark, folder + "-empty").collect() == []


def test_letters_go_to_the_model_alone():
    path = default_tokenizer()
    plain, own = Tokenizer.from_file(path), Encoder(path)
    words = [f"a{chr(c)}B" for c in range(0x21, 0x600)] + ["STRASSE", "Straße", "ŒUVRE", "İz", "ŉa", "ſs", "ét", "don't", "x" * 900]
    assert own.direct and [x.tolist() for x in own.encode(w.encode() for w in words)] == [plain.encode(w, add_special_tokens=False).ids for w in words]


def test_only_distinct_pieces_are_objects():
    own, text = Encoder(default_tokenizer()), b" ".join(b"w%d" % (i % 500) for i in range(400_000))
    want = list(own.encode([text], 2))[0]
    tracemalloc.start()
    got = list(own.encode([text], 2))[0]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (got == want).all() and got[-1] == 2
    assert peak < 6 * len(text)

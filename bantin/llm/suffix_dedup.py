"""Suffix-array dedup: bytes of passages that also start earlier go.

A byte goes when a string of LENGTH bytes over it also starts earlier: in a document with a smaller
doc_id, or before in the same one. Which strings repeat is told by suffix arrays over small bins that
between them hold every two places that may agree:

1. Every window of LENGTH bytes picks one of its ANCHOR-byte strings, by hash; equal windows pick
   equal ones. Neighbouring windows mostly pick the same place, and so form a stretch. A stretch goes
   to the bin of its anchor; stretches whose anchor is met once cannot repeat and end here.
2. Equal stretches (whole copies inside a passage) collapse to the earliest, natively; the others
   are removed, those of the same text at once. What is left of an anchor, if there are different stretches, is sorted.
3. A bin's stretches are joined into one text; its suffix array is made by two-stage sorting, and
   windows whose common prefix reaches LENGTH are equal: all but the earliest go.

Copies of whole documents collapse to the smallest doc_id before that. A bin holds about BIN_BYTES;
an anchor with more than HOT_STRETCHES different stretches is not sorted but dealt out by the hashes
of its windows, of which the earliest stays. Stretches, documents and those windows are told apart by
64 bits and more of their hashes; bytes are compared in the suffix arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bantin.llm.common import as_bytes, merged, mixed, powers, query, stored, table, whole_text
from bantin.llm.seen_twice import SeenTwice, seen_twice

LENGTH = 100
ANCHOR = 32
BIN_BYTES = 256 << 10
HOT_STRETCHES = 2_000
# A longer text is looked through in parts of this size that overlap by LENGTH - 1.
_PART = 4 << 20
_PLACE_BITS = np.uint64(24)
_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)


# --- stretches --------------------------------------------------------------------------

def _run_hashes(values: np.ndarray, n: int) -> np.ndarray:
    """A hash of every run of n values, built from runs of powers of two."""
    out, size, rest, done = values, 1, n, None
    covered = 0
    while rest:
        if rest & 1:
            done = out if done is None else done[: len(values) - covered - size + 1] * np.uint64(_BASE) + out[covered : covered + len(values) - covered - size + 1]
            covered += size
        rest >>= 1
        if rest:
            out = mixed(out[:-size] * np.uint64(0xC2B2AE3D27D4EB4F) + out[size:]) if len(out) > size else out[:0]
            size *= 2
    return mixed(done)


def _sliding_min(values: np.ndarray, n: int) -> np.ndarray:
    out, size = values, 1
    while 2 * size <= n:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    return np.minimum(out[: len(values) - n + 1], out[n - size :]) if size < n else out


def stretches(text: bytes, length: int = LENGTH, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """Anchor hash, content hash, first window and number of windows of each stretch of a text."""
    parts = []
    for at in range(0, max(1, len(text) - length + 1), _PART):
        data = _BYTE[np.frombuffer(text, np.uint8, min(len(text) - at, _PART + length - 1), at)]
        if len(data) < length:
            continue
        hashes = _run_hashes(data, anchor)
        keys = (hashes >> _PLACE_BITS << _PLACE_BITS) | np.arange(len(hashes), dtype=np.uint64)
        places = (_sliding_min(keys, length - anchor + 1) & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1]]))
        count = np.diff(np.append(first, len(places)))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(data * powers(len(data), _BASE), dtype=np.uint64)])
        inside = (sums[first + count + length - 1] - sums[first]) * powers(len(data), _INVERSE)[first]
        content = mixed(inside + count.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        parts.append((hashes[places[first]], content, first + at, count))
    if not parts:
        return np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*parts))


# --- suffix arrays ----------------------------------------------------------------------

def suffix_array(text: bytes, depth: int) -> list[int]:
    """Suffixes of a text that ends with its smallest byte, told apart by `depth` bytes, by two-stage sorting.

    Only suffixes smaller than their successors are sorted directly. Every other one is larger than
    its successor, which therefore comes before it: a scan of the buckets from the left meets the
    successors in order and puts each such suffix at the next free place of its bucket's front.
    """
    n = len(text)
    if not n:
        return []
    codes = np.frombuffer(text, np.uint8).astype(np.int16)
    differs = np.flatnonzero(codes[1:] != codes[:-1])
    after = np.searchsorted(differs, np.arange(n - 1))
    rises = np.ones(n, bool)  # the last suffix has no successor and is sorted directly
    inside = after < len(differs)
    at = differs[after[inside]]
    rises[:-1][inside] = codes[at] < codes[at + 1]
    direct = sorted(np.flatnonzero(rises).tolist(), key=lambda i: text[i : i + depth])
    sizes = np.bincount(codes, minlength=256)
    ends = np.cumsum(sizes)
    order = [-1] * n
    per_bucket = np.bincount(codes[rises], minlength=256)
    place = (ends - per_bucket).tolist()
    for i in direct:
        c = text[i]
        order[place[c]] = i
        place[c] += 1
    front = (ends - sizes).tolist()
    induced = (~rises).tolist()
    for i in order:
        if i > 0 and induced[i - 1]:
            c = text[i - 1]
            order[front[c]] = i - 1
            front[c] += 1
    return order


def common_prefixes(text: bytes, order: np.ndarray, most: int) -> np.ndarray:
    """Common prefix, up to `most`, of each suffix with the one before it; all have `most` bytes."""
    windows = np.lib.stride_tricks.sliding_window_view(np.frombuffer(text, np.uint8), most)
    out = np.zeros(len(order), np.int64)
    for a in range(1, len(order), 20_000):
        b = min(a + 20_000, len(order))
        same = windows[order[a - 1 : b - 1]] == windows[order[a:b]]
        out[a:b] = np.where(same.all(axis=1), most, same.argmin(axis=1))
    return out


_SHIFT = bytes(range(1, 256)) + b"\xff"  # UTF-8 has no byte 255; 0 is free to end a stretch


def repeated_windows(pieces: list[bytes], docs: np.ndarray, starts: np.ndarray, length: int = LENGTH) -> list[tuple[int, int]]:
    """(piece, start) of the windows in the pieces that equal an earlier one, by (doc, start)."""
    text = b"".join(p.translate(_SHIFT) + b"\0" for p in pieces)
    sizes = np.array([len(p) + 1 for p in pieces])
    owner = np.repeat(np.arange(len(pieces)), sizes)
    begin = np.cumsum(sizes) - sizes
    order = np.array(suffix_array(text, int(sizes.max())), np.int64)
    room = begin[owner] + sizes[owner] - 1 - np.arange(len(text))
    order = order[room[order] >= length]
    if not len(order):
        return []
    group = np.cumsum(common_prefixes(text, order, length) < length)
    piece, start = owner[order], starts[owner[order]] + order - begin[owner[order]]
    by = np.lexsort((start, docs[piece], group))
    piece, start, group = piece[by], start[by], group[by]
    heads = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    lead = np.repeat(heads, np.diff(np.append(heads, len(group))))
    # Texts that share a doc_id may have a window at one place: then neither is earlier.
    later = (docs[piece] != docs[piece[lead]]) | (start != start[lead])
    return list(zip(piece[later].tolist(), start[later].tolist()))


# --- the job ------------------------------------------------------------------------------

def _documents(docs: DataFrame) -> DataFrame:
    """id (null: before all others), text, and `same`, a hash that stands for the text."""
    lowest = F.lit(-(2**63)).cast("long")
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), lowest).alias("id"), whole_text().alias("text")).withColumn("same", F.xxhash64("text"))


def _stretch_rows(length: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()  # copies within a task are looked at once
        for batch in batches:
            found = []
            for same, text in zip(batch["same"].to_pylist(), as_bytes(batch["text"])):
                if len(text) >= length and same not in met:
                    met.add(same)
                    a, c, first, count = stretches(text, length, anchor)
                    # What a text repeats of itself goes, whoever else has it: dealt by place, not by anchor.
                    again = np.ones(len(a), bool)
                    again[np.unique(a ^ mixed(c), return_index=True)[1]] = False
                    place = mixed(np.uint64(same & (2**64 - 1)) + first.astype(np.uint64) * np.uint64(_BASE))
                    a = np.where(again, place, a).view(np.int64)
                    found.append((a, c.view(np.int64), np.full(len(a), same, np.int64), first, np.where(again, -count, count)))
            if found:
                columns = [np.concatenate(x) for x in zip(*found)]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], ["anchor", "content", "same", "first", "count"])

    return run


def _member_filter(df: DataFrame, column: str) -> SeenTwice:
    """A Bloom filter of fixed size that knows all values of a column."""
    return seen_twice(df.select(column), lambda b: np.repeat(mixed(b[column].to_numpy().view(np.uint64)), 2))


def _texts_of(documents: DataFrame, wanted: SeenTwice) -> DataFrame:
    """Documents that the filter may know; the others' texts are not moved."""
    shared = documents.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(shared.value.has(mixed(batch["same"].to_numpy().view(np.uint64)))))

    return documents.mapInArrow(run, documents.schema)


def removed_spans(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """One row per different text: same, keeper (its smallest id) and `spans`, the removed byte runs of the keeper."""
    documents = _documents(docs)
    # Copies of whole documents; hot ones combine in every task.
    texts = stored(documents.groupBy("same", F.hash("text").alias("_check"), F.octet_length("text").alias("_n")).agg(F.min("id").alias("keeper")).select("same", "keeper"))

    # A negative count marks a stretch that its own text has before.
    rows = documents.select("same", "text").mapInArrow(_stretch_rows(length, anchor), "anchor long, content long, same long, first long, count long")
    by_anchor = Window.partitionBy("anchor")
    place = F.struct("same", "first")
    met = rows.select("*", F.min(place).over(by_anchor).alias("_a"), F.max(place).over(by_anchor).alias("_b")).where("_a <> _b OR count < 0").drop("_a", "_b")
    known = met.distinct().join(texts, "same")

    owners = Window.partitionBy("anchor", "content").orderBy("keeper", "first")
    ranked = known.repartition("anchor").select("*", F.rank().over(owners).alias("_rank"))
    ranked = ranked.select("*", F.sum(F.when(F.col("_rank") == 1, 1).otherwise(0)).over(by_anchor).alias("kinds"))
    copy = (F.col("_rank") > 1) | (F.col("count") < 0)
    ranked = stored(ranked.select("anchor", "same", "keeper", "first", F.abs("count").alias("count"), "kinds", copy.alias("copy")))

    span = F.struct(F.col("first").alias("a"), (F.col("first") + F.col("count") + length - 1).alias("b"))
    whole = ranked.where("copy").select("same", span.alias("span"))
    unsure = ranked.where("NOT copy AND kinds > 1")
    parts = whole.unionByName(_sorted_spans(documents, unsure, length))
    return texts.join(parts.groupBy("same").agg(F.collect_list("span").alias("spans")), "same", "left")


def _sorted_spans(documents: DataFrame, unsure: DataFrame, length: int) -> DataFrame:
    """Spans of windows that equal an earlier one, among stretches that share an anchor only."""
    spark = documents.sparkSession
    total = unsure.agg(F.sum(F.col("count") + length)).first()[0] or 0
    bins = max(1, total // BIN_BYTES)
    stretch = F.struct("anchor", "first", "count", (F.col("kinds") > HOT_STRETCHES).alias("hot"))
    asked = unsure.groupBy("same", "keeper").agg(F.collect_list(stretch).alias("stretches"))
    texts = _texts_of(documents.select("same", "text"), _member_filter(unsure.select("same").distinct(), "same")).dropDuplicates(["same"])
    asked = asked.join(texts, "same")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for same, keeper, found, text in zip(*(batch[c].to_pylist() for c in ("same", "keeper", "stretches")), as_bytes(batch["text"])):
                for s in found:
                    data = text[s["first"] : s["first"] + s["count"] + length - 1]
                    if s["hot"]:
                        for i in range(s["count"]):
                            digest = xxhash.xxh3_128_digest(data[i : i + length])
                            rows.append((0, same, keeper, s["first"] + i, digest, True))
                    else:
                        rows.append(((s["anchor"] & (2**63 - 1)) % bins, same, keeper, s["first"], data, False))
            if rows:
                types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["bin", "same", "keeper", "first", "data", "hot"])

    cuts = stored(asked.mapInArrow(cut, "bin long, same long, keeper long, first long, data binary, hot boolean"))

    def judge(table_: pa.Table) -> pa.Table:
        same, keeper, first = (table_[c].to_numpy() for c in ("same", "keeper", "first"))
        later = repeated_windows(table_["data"].to_pylist(), keeper, first, length)
        spans: dict[int, list[tuple[int, int]]] = {}  # by text: texts may share a doc_id
        for piece, start in later:
            spans.setdefault(int(same[piece]), []).append((start, start + length))
        rows = [(t, {"a": a, "b": b}) for t, x in spans.items() for a, b in merged(x)]
        kind = pa.struct([("a", pa.int64()), ("b", pa.int64())])
        return pa.table([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], kind)], ["same", "span"])

    sorted_ = cuts.where("NOT hot").groupBy("bin").applyInArrow(judge, "same long, span struct<a:long,b:long>")
    hot = cuts.where("hot").select("same", "keeper", "first", "data")
    earliest = stored(hot.groupBy("data").agg(F.min(F.struct("keeper", "first")).alias("one")))
    later = hot.join(earliest, "data").where(F.struct("keeper", "first") != F.col("one"))
    return sorted_.unionByName(later.select("same", F.struct(F.col("first").alias("a"), (F.col("first") + length).alias("b")).alias("span")))


def remove_repeats(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, `spans` (removed byte runs), and `kept`, the bytes left.

    Texts are UTF-8 bytes, so `kept` need not be valid text. A null text is empty; a text shorter than
    `length` keeps all. Rows with one doc_id and the same text are one document, and both stay or go
    alike; a null doc_id comes before all others. Other columns are not looked at.
    """
    lowest = -(2**63)
    spans = stored(removed_spans(docs, length, anchor))
    # A stored table on this side lets adaptive execution split the copies of one text.
    joined = _documents(docs).join(spans, "same", "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
        for batch in batches:
            sizes, gone, kept = [], [], []
            for own, keeper, text, spans in zip(batch["id"].to_pylist(), batch["keeper"].to_pylist(), as_bytes(batch["text"]), batch["spans"].to_pylist()):
                runs = merged([(s["a"], s["b"]) for s in spans or []])
                if own != keeper and len(text) >= length:
                    runs = [(0, len(text))]
                at, parts = 0, []
                for a, b in runs:
                    parts.append(text[at:a])
                    at = b
                sizes.append(len(text))
                gone.append([{"a": a, "b": b} for a, b in runs])
                kept.append(b"".join([*parts, text[at:]]))
            ids = pa.array([None if i == lowest else i for i in batch["id"].to_pylist()], pa.int64())
            removed = pa.array([n - len(k) for n, k in zip(sizes, kept)], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(sizes, pa.int64()), removed, pa.array(gone, kind), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "spans", "kept"],
            )

    return joined.select("id", "keeper", "text", "spans").mapInArrow(
        cut, "doc_id long, n_bytes long, n_removed long, spans array<struct<a:long,b:long>>, kept binary"
    )


@query()
def op10_suffix_dedup(spark, sf_dir):
    """Every document without the passages that start earlier elsewhere."""
    left = remove_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))

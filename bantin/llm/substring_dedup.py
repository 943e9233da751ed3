"""Substring dedup over words: every word in a run of WINDOW words that also starts elsewhere goes.

A De Bruijn graph of the corpus: its edges are the k-mers of k = WINDOW words, its nodes the runs of
k - 1 words between them. An edge met twice is repeated, and the rest of the graph is of no interest.

1. Edges travel in bundles. Each picks, by hash, one of its runs of ANCHOR words; equal edges pick the
   same one. Neighbours that picked the same place are one row: a path of edges with its source
   coordinates (text, place). Anchors met once hold no repeated edge and end there.
2. Where all paths of an anchor are equal, they are one repeated segment. Else the different paths are
   taken apart into edges, which are counted; neighbouring edges that the same paths hold are a segment.
3. Segments that follow each other in a text are arcs. An arc does not branch if nothing else follows
   the one and nothing else comes before the other, in any text. Joined back to the sources, the flags
   compact the graph: a path without branches is walked whole by every source that enters it, so each
   text can cut its segments at the branches alone.
4. Source coordinates verify the compacted paths: the words at each place are compared by a 128-bit
   digest. A path whose places do not agree is compared window by window.

Paths and edges are told apart by 64 bits within an anchor of 64 bits, texts by MD5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bantin.llm.common import WORD_HASHES, as_bytes, claim, merged, mixed, powers, query, small_parts, stored, table, whole_text, window_hashes
from bantin.llm.seen_twice import SeenTwice, seen_twice
from bantin.llm.suffix_dedup import _sliding_min

WINDOW = 35
ANCHOR = 8
# A longer text is looked through in parts of this many words that overlap by WINDOW - 1.
_PART = 4 << 20
_PLACE_BITS = np.uint64(24)
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)


# --- edges of one text ------------------------------------------------------------------


def _spans_hashed(hashes: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each [first, end) of the words, that does not depend on its place."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * powers(len(hashes), _BASE), dtype=np.uint64)])
    inside = (sums[end] - sums[first]) * powers(len(hashes), _INVERSE)[first]
    return mixed(inside + (end - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def bundles(hashes: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Anchor hash, content hash, first edge and number of edges of each bundle of a text's edges."""
    parts = []
    for at in range(0, max(1, len(hashes) - window + 1), _PART):
        part = hashes[at : at + _PART + window - 1]
        if len(part) < window:
            continue
        anchors = window_hashes(part, anchor)
        keys = (anchors >> _PLACE_BITS << _PLACE_BITS) | np.arange(len(anchors), dtype=np.uint64)
        places = (_sliding_min(keys, window - anchor + 1) & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1]]))
        count = np.diff(np.append(first, len(places)))
        parts.append((anchors[places[first]], _spans_hashed(part, first, first + count + window - 1), first + at, count))
    if not parts:
        return np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*parts))


def _bundle_rows(window: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("words")
        met: dict[bytes, int] = {}
        for batch in small_parts(batches, 1_000):
            found, names = [], []
            for same, text in zip(batch["same"].to_pylist(), as_bytes(batch["text"])):
                # The second copy shows that all is repeated; more would say no more.
                if met.get(same, 0) < 2:
                    met[same] = met.get(same, 0) + 1
                    words = text.split()
                    if len(words) >= window:
                        found.append(bundles(WORD_HASHES.of(words), window, anchor))
                        names.append((same, len(found[-1][0])))
            if found:
                a, c, first, count = (np.concatenate(x) for x in zip(*found))
                owner = pa.array([n for n, _ in names], pa.binary()).take(pa.array(np.repeat(np.arange(len(names)), [k for _, k in names])))
                columns = [pa.array(a.view(np.int64)), pa.array(c.view(np.int64)), owner, pa.array(first), pa.array(count)]
                yield pa.RecordBatch.from_arrays(columns, ["anchor", "content", "same", "first", "count"])

    return run


# --- filters of fixed size: they only keep rows from being moved ------------------------


def _name_hashes(column: pa.Array) -> np.ndarray:
    if pa.types.is_integer(column.type):
        return mixed(column.to_numpy().view(np.uint64))
    return mixed(np.frombuffer(b"".join(column.to_pylist()), "<u8").reshape(-1, 2)[:, 0].astype(np.uint64))


def _members(df: DataFrame, column: str) -> SeenTwice:
    return seen_twice(df.select(column), lambda b: np.repeat(_name_hashes(b[column]), 2))


def _only(df: DataFrame, column: str, known: SeenTwice) -> DataFrame:
    """The rows whose name the filter may know."""
    shared = df.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_parts(batches, 5_000):
            yield batch.filter(pa.array(shared.value.has(_name_hashes(batch[column]))))

    return df.mapInArrow(run, df.schema)


# --- the graph --------------------------------------------------------------------------


def _sources(docs: DataFrame) -> DataFrame:
    """doc_id, text, and `same`, which stands for the text."""
    return docs.select(F.col("doc_id").cast("long"), whole_text().alias("text")).withColumn("same", F.unhex(F.md5("text")))


def _segments(texts: DataFrame, mixed_paths: DataFrame, window: int) -> DataFrame:
    """anchor, content, at, n_edges, seg: the repeated segments of each different path of an anchor."""
    kinds = stored(mixed_paths.groupBy("anchor", "content").agg(F.count("*").alias("n"), F.min(F.struct("same", "first", "count")).alias("one")))
    path = F.struct("anchor", "content", F.col("one.first").alias("first"), F.col("one.count").alias("count"), "n")
    asked = stored(kinds.groupBy(F.col("one.same").alias("same")).agg(F.collect_list(path).alias("paths")))
    held = _only(texts.select("same", "text"), "same", _members(asked, "same")).dropDuplicates(["same"]).join(asked, "same")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, paths in zip(as_bytes(batch["text"]), batch["paths"]):
                hashes = WORD_HASHES.of(text.split())
                fields = [paths.values.field(k).to_numpy() for k in ("anchor", "content", "first", "count", "n")]
                count = fields[3]
                at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                start = np.repeat(fields[2], count) + at
                edge = _spans_hashed(hashes, start, start + window)
                columns = [np.repeat(fields[0], count), np.repeat(fields[1], count), np.repeat(fields[4], count), at, edge.view(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["anchor", "content", "n", "at", "edge"])

    edges = stored(held.select("text", "paths").mapInArrow(run, "anchor long, content long, n long, at long, edge long"))
    # The set of paths that hold an edge, as one number; a path holds an edge once.
    counted = edges.groupBy("anchor", "edge").agg(F.sum("n").alias("total"), F.bit_xor(F.xxhash64("content")).alias("held_by"))
    again = edges.join(stored(counted.where("total > 1")), ["anchor", "edge"])
    in_path = Window.partitionBy("anchor", "content").orderBy("at")
    goes_on = (F.lag("at").over(in_path) == F.col("at") - 1) & (F.lag("held_by").over(in_path) == F.col("held_by"))
    cut = again.withColumn("new", F.when(goes_on, 0).otherwise(1)).withColumn("part", F.sum("new").over(in_path))
    ends = cut.groupBy("anchor", "content", "part").agg(
        F.min("at").alias("at"), F.count("*").alias("n_edges"), F.min_by("edge", "at").alias("head"), F.max_by("edge", "at").alias("tail")
    )
    return stored(ends.select("anchor", "content", "at", "n_edges", F.xxhash64("anchor", "head", "tail").alias("seg")))


def _compacted(occurrences: DataFrame, window: int) -> DataFrame:
    """same and `spans` (start, words, path): the unbranched paths of repeated edges, by source."""
    in_text = Window.partitionBy("same").orderBy("pos")
    touches = F.lead("pos").over(in_text) == F.col("pos") + F.col("n_edges")
    touched = F.lag(F.col("pos") + F.col("n_edges")).over(in_text) == F.col("pos")
    arcs = stored(
        occurrences.select(
            "*", F.when(touches, F.lead("seg").over(in_text)).alias("after"), F.when(touched, F.lag("seg").over(in_text)).alias("before")
        )
    )
    alone = lambda c: F.coalesce((F.min(c) == F.max(c)) & (F.count(c) == F.count("*")), F.lit(False))
    flags = stored(arcs.groupBy("seg").agg(alone("after").alias("leaves_alone"), alone("before").alias("entered_alone")))
    flagged = arcs.join(flags, "seg")
    joins = F.col("before").isNotNull() & F.col("entered_alone") & F.lag("leaves_alone").over(in_text)
    parts = flagged.withColumn("new", F.when(joins, 0).otherwise(1)).withColumn("part", F.sum("new").over(in_text))
    spans = parts.groupBy("same", "part").agg(F.min("pos").alias("start"), (F.sum("n_edges") + window - 1).alias("words"), F.min_by("seg", "pos").alias("path"))
    return spans.groupBy("same").agg(F.collect_list(F.struct("start", "words", "path")).alias("spans"))


def repeated_paths(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """same (the MD5 of a text) and `spans` (start, words, path), the compacted paths of repeated edges in it."""
    texts = _sources(docs)
    rows = stored(texts.select("same", "text").mapInArrow(_bundle_rows(window, anchor), "anchor long, content long, same binary, first long, count long"))
    anchors = rows.groupBy("anchor").agg(F.count("*").alias("n"), (F.min("content") != F.max("content")).alias("mixed"))
    anchors = stored(anchors.where("n > 1").select("anchor", "mixed"))
    known = _only(rows, "anchor", _members(anchors, "anchor")).join(anchors, "anchor")
    # Rows as they are tell how often a path occurs; its places are counted once.
    segments = _segments(texts, known.where("mixed"), window)
    places = known.distinct()
    whole = places.where("NOT mixed").select("same", F.col("first").alias("pos"), F.col("count").alias("n_edges"), F.xxhash64("anchor", "content").alias("seg"))
    parts = places.where("mixed").join(segments, ["anchor", "content"]).select("same", (F.col("first") + F.col("at")).alias("pos"), "n_edges", "seg")
    return stored(_compacted(whole.unionByName(parts), window))


# --- texts without them -----------------------------------------------------------------

_SPANS = "array<struct<start:long,words:long,path:long>>"
_RESULT = "doc_id long, same binary, n_words long, n_removed long, removed array<struct<a:long,b:long>>, kept string"
_CHECKED = "checked array<struct<start:long,path:long,digest:binary>>"


def _cut(texts: DataFrame, left_out: SeenTwice | None = None) -> DataFrame:
    """Texts without their spans, and the digest of the words of each span; not those the filter may know."""
    shared = texts.sparkSession.sparkContext.broadcast(left_out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
        checks = pa.list_(pa.struct([("start", pa.int64()), ("path", pa.int64()), ("digest", pa.binary())]))
        for batch in small_parts(batches, 1_000):
            if shared.value is not None:
                batch = batch.filter(pa.array(~shared.value.has(_name_hashes(batch["same"]))))
            n_words, n_removed, removed, kept, checked = [], [], [], [], []
            for text, spans in zip(as_bytes(batch["text"]), batch["spans"].to_pylist()):
                words = text.split()
                places = [(s["start"], s["start"] + s["words"], s["path"]) for s in spans or []]
                checked.append([{"start": a, "path": p, "digest": xxhash.xxh3_128_digest(b" ".join(words[a:b]))} for a, b, p in places])
                gone = merged([(a, b) for a, b, _ in places])
                removed.append([{"a": a, "b": b} for a, b in gone])
                n_words.append(len(words))
                n_removed.append(sum(b - a for a, b in gone))
                for a, b in reversed(gone):
                    del words[a:b]
                kept.append(b" ".join(words))
            columns = [
                batch["doc_id"], batch["same"], pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(removed, runs),
                pa.array(kept, pa.binary()).view(pa.string()), pa.array(checked, checks),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "same", "n_words", "n_removed", "removed", "kept", "checked"])

    return texts.select("doc_id", "same", "text", "spans").mapInArrow(run, f"{_RESULT}, {_CHECKED}")


def _told_by_windows(texts: DataFrame, spans: DataFrame, wrong: DataFrame, window: int) -> DataFrame:
    """The spans, where those of paths whose places differ are replaced by their windows that do repeat."""
    each = spans.select("same", F.explode("spans").alias("s")).select("same", "s.start", "s.words", "s.path")
    places = F.sequence(F.col("start"), F.col("start") + F.col("words") - window)
    windows = each.join(wrong, "path", "left_semi").select("same", F.explode(places).alias("start"), F.lit(window).cast("long").alias("words"), "path")
    asked = stored(windows.groupBy("same").agg(F.collect_list(F.struct("start", "words", "path")).alias("spans")))
    found = stored(_cut(texts.join(asked, "same")).select("same", F.explode("checked").alias("c")).select("same", "c.start", "c.digest"))
    again = stored(found.groupBy("digest").count().where("count > 1"))
    right = found.join(again, "digest", "left_semi").select("same", "start").distinct()
    right = right.select("same", "start", F.lit(window).cast("long").alias("words"), F.lit(0).cast("long").alias("path"))
    kept = each.join(wrong, "path", "left_anti").unionByName(right)
    return stored(kept.groupBy("same").agg(F.collect_list(F.struct("start", "words", "path")).alias("spans")))


def remove_repeated_spans(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, `removed` (runs [a, b) of words) and `kept`, the other words.

    Words are divided by ASCII white space, kept ones joined by one space. Every copy of a repeated run of
    `window` words goes, the first as well; a text of fewer words keeps all. Repeated rows are copies of
    each other, whatever their doc_id, which may be null. A null text has no words. Other columns are
    not looked at.
    """
    texts = _sources(docs)
    spans = repeated_paths(docs, window, anchor)
    known = _members(spans, "same")
    hit = _only(texts, "same", known)
    cut = stored(_cut(hit.join(spans, "same", "left")))
    places = cut.select(F.explode("checked").alias("c")).select("c.path", "c.digest")
    wrong = stored(places.groupBy("path", "digest").count().where("count < 2").select("path").distinct())
    if not wrong.isEmpty():
        cut = _cut(hit.join(_told_by_windows(hit, spans, wrong, window), "same", "left"))
    others = _cut(texts.withColumn("spans", F.lit(None).cast(_SPANS)), left_out=known)
    return cut.unionByName(others).drop("checked", "same")


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

SQL = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS id, doc_id, {_WORDS} AS w FROM documents),
e AS MATERIALIZED (SELECT id, i, array_to_string(w[i : i + {WINDOW - 1}], ' ') AS s
  FROM (SELECT id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM d WHERE len(w) >= {WINDOW})),
r AS (SELECT id, i FROM e WHERE s IN (SELECT s FROM e GROUP BY s HAVING count(*) > 1)),
g AS (SELECT id, list(DISTINCT i + k) AS gone FROM r, range({WINDOW}) t(k) GROUP BY id),
k AS (SELECT doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed,
    list_filter(w, lambda x, i: gone IS NULL OR NOT list_contains(gone, i)) AS kept FROM d LEFT JOIN g USING (id))
SELECT doc_id, n_words::BIGINT AS n_words, n_removed::BIGINT AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM k
"""


@query(SQL)
def op11_substring_dedup(spark, sf_dir):
    """Every document without the runs of 35 words that also start elsewhere."""
    left = remove_repeated_spans(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))

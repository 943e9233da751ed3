"""Benchmark decontamination: windows of benchmark words, broadcast as a hash set, found in documents.

Every window of `n` neighbouring benchmark words (an item with fewer words is one window) goes
into a set of 64-bit hashes that is broadcast; documents are scanned without a shuffle, a hash hit
is verified against the window's own words, and hit words are reported as spans or removed.

A broadcast holds at most `max_windows` windows. A larger benchmark is dealt by window hash into
several sets and the documents pass them one after another, each pass adding to the spans found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bantin.llm.common import WORD_HASHES, as_bytes, claim, merged, query, release, rows_out, small_parts, stored, table, whole_text, window_hashes

WINDOW = 10
# Windows in one broadcast: about 100 bytes each, so 50 MB.
MAX_WINDOWS = 500_000

# A-Z become a-z; every other ASCII character that is not a digit or a-z ends a word.
_NORMAL = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_NORMAL).split()


def _benchmark_windows(n: int):
    schema = pa.schema([("item_id", pa.int64()), ("length", pa.int32()), ("hash", pa.int64()), ("words", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item, text in zip(batch["item_id"].to_pylist(), as_bytes(batch["text"])):
                words = words_of(text)
                length = min(n, len(words))
                if length:
                    hashes = window_hashes(WORD_HASHES.of(words), length).view(np.int64).tolist()
                    rows += [(item, length, h, b" ".join(words[i : i + length])) for i, h in enumerate(hashes)]
            yield from rows_out(schema, rows)

    return run, "item_id long, length int, hash long, words binary"


class _WindowSet:
    """Windows by length: their hashes in order, and for each hash its words and items."""

    def __init__(self, rows: pa.Table) -> None:
        self.known: dict[int, dict[int, dict[bytes, list[int]]]] = {}
        columns = (rows[c].to_pylist() for c in ("length", "hash", "words", "item_id"))
        for length, h, words, item in zip(*columns):
            self.known.setdefault(length, {}).setdefault(h & (2**64 - 1), {}).setdefault(words, []).append(item)
        self.sorted = {length: np.sort(np.fromiter(x, np.uint64, len(x))) for length, x in self.known.items()}

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Word runs [from, to) covered by benchmark windows, and the items these belong to."""
        runs, items = [], set()
        hashes = WORD_HASHES.of(words)
        for length, keys in self.sorted.items():
            got = window_hashes(hashes, length)
            if not len(got):
                continue
            at = np.searchsorted(keys, got)
            at[at == len(keys)] = 0
            for i in np.flatnonzero(keys[at] == got).tolist():
                found = self.known[length][int(got[i])].get(b" ".join(words[i : i + length]))
                if found:
                    runs.append((i, i + length))
                    items.update(found)
        return merged(runs), items


def benchmark_hits(
    docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, max_windows: int = MAX_WINDOWS
) -> DataFrame:
    """One row per document: `row` (its other columns), `text`, `n_words`, `runs`, `items`.

    `runs` are the merged word runs [a, b) that benchmark windows cover, `items` the distinct
    item_ids with a window there. Null or wordless items and texts match nothing; a null item_id
    counts for its words but is no item. Repeated rows are each answered on their own. Columns of
    any name may be present: they stay inside `row`.
    """
    spark = docs.sparkSession
    make, schema = _benchmark_windows(n)
    windows = stored(benchmark.select(F.col("item_id").cast("long"), whole_text().alias("text")).mapInArrow(make, schema).distinct())
    shards = max(1, -(-windows.count() // max_windows))
    state = docs.select(
        F.struct(*[c for c in docs.columns if c != "text"]).alias("row"), F.col("text").cast("string").alias("text"), F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<struct<a:int,b:int>>").alias("runs"), F.array().cast("array<bigint>").alias("items"),
    )
    for shard in range(shards):
        part = windows.where(F.pmod("hash", F.lit(shards)) == shard) if shards > 1 else windows
        found = spark.sparkContext.broadcast(part.toArrow())
        state = (stored(state) if shard else state).mapInArrow(_scan(found), state.schema)
    return state


def _scan(broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("words")
        windows = _WindowSet(broadcast.value)
        for batch in small_parts(batches):
            n_words, runs, items = [], [], []
            before = zip(as_bytes(batch["text"]), batch["runs"].to_pylist(), batch["items"].to_pylist())
            for text, old_runs, old_items in before:
                words = words_of(text or b"")
                new_runs, new_items = windows.find(words)
                n_words.append(len(words))
                runs.append([{"a": a, "b": b} for a, b in merged(new_runs + [(r["a"], r["b"]) for r in old_runs])])
                items.append(sorted({x for x in new_items if x is not None} | set(old_items)))
            columns = [batch["row"], batch["text"], n_words, runs, items]
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, batch.schema)],
                schema=batch.schema,
            )
        del windows
        release()

    return run


def _without_runs(text: bytes, runs: list[dict]) -> bytes:
    """The text without the words of the runs and what stands between them."""
    shown = text.translate(_NORMAL)
    bounds, end = [], 0
    for word in shown.split():
        start = shown.index(word, end)
        end = start + len(word)
        bounds.append((start, end))
    kept, at = [], 0
    for run in runs:
        kept.append(text[at : bounds[run["a"]][0]])
        at = bounds[run["b"] - 1][1]
    return b"".join([*kept, text[at:]])


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, remove: str = "documents", n: int = WINDOW, max_windows: int = MAX_WINDOWS
) -> DataFrame:
    """The documents without those that hold a benchmark window, or (`remove="spans"`) without the spans.

    All columns stay as they are but for the cleaned text. Nulls and other odd rows: see `benchmark_hits`.
    """
    hits = benchmark_hits(docs, benchmark, n, max_windows)
    if remove == "documents":
        clean = hits.where(F.size("runs") == 0)
        return clean.select(*[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])
    if remove != "spans":
        raise ValueError(f"remove must be 'documents' or 'spans', not {remove!r}")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                _without_runs(t, r).decode() if r else t if t is None else t.decode()
                for t, r in zip(as_bytes(batch["text"]), batch["runs"].to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([batch["row"], pa.array(texts, pa.string())], ["row", "text"])

    hits = hits.select("row", "text", "runs")
    cleaned = hits.mapInArrow(cut, hits.drop("runs").schema)
    return cleaned.select(*[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])


def contamination_report(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    hits = benchmark_hits(docs.select("doc_id", "text"), benchmark, n, max_windows)
    covered = F.aggregate("runs", F.lit(0).cast("long"), lambda total, r: total + (r["b"] - r["a"]))
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return hits.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", covered.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"), F.sha2(names, 256).alias("items_sha256"),
        (F.size("runs") > 0).alias("contaminated"),
    )


_WORDS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
b AS (SELECT item_id, {_WORDS.format("coalesce(text, '')")} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least({WINDOW}, len(w)) AS n, array_to_string(w[i : i + least({WINDOW}, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least({WINDOW}, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
ns AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, ns WHERE len(w) >= n)),
hit AS (SELECT DISTINCT doc_id, item_id, dw.n, i FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win),
spots AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
  FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN spots ON spots.doc_id = d.doc_id LEFT JOIN it ON it.doc_id = d.doc_id
"""


@query(SQL)
def op3_benchmark_decontamination(spark, sf_dir):
    """Every document against every benchmark item."""
    return contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

"""Line dedup: lines that several documents share stay in one of them.

A pair of Bloom filters (`seen_twice`) finds the lines that may repeat; only these are shuffled, as
whole keys, to be counted exactly and to choose the document that keeps them. The filters decide
nothing: a false hit is counted and found to be rare.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bantin.llm.common import as_bytes, claim, query, small_parts, stored, table, whole_text, with_fields
from bantin.llm.seen_twice import BITS_LOG2, seen_twice

MIN_CHARS = 20
MIN_DOCS = 3
_SPACE = b" \t\n\x0b\x0c\r"


def line_key(line: bytes) -> bytes:
    return line.strip(_SPACE).lower()


def _long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode()) >= min_chars)


def _keys(text: bytes, min_chars: int) -> set[bytes]:
    return {k for k in map(line_key, text.split(b"\n")) if _long_enough(k, min_chars)}


def _hashes(keys) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(k) for k in keys], np.uint64)


def shared_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, bits_log2: int = BITS_LOG2) -> DataFrame:
    """doc_id and `keys`: the line keys that the document loses, for documents that lose any.

    A key of at least `min_chars` code points in at least `min_docs` documents is lost by all but
    the largest doc_id. Rows of one doc_id are one document; a null doc_id is one document, the
    smallest. Null and empty texts have one empty line, which is too short to matter.
    """
    texts = docs.select(F.col("doc_id").cast("long"), whole_text().alias("text"))

    def per_batch(batch: pa.RecordBatch) -> np.ndarray:
        return np.concatenate([np.empty(0, np.uint64), *(_hashes(_keys(t, min_chars)) for t in as_bytes(batch["text"]))])

    spark = docs.sparkSession
    found = spark.sparkContext.broadcast(seen_twice(texts.select("text"), per_batch, bits_log2))

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("lines")
        for batch in small_parts(batches):
            rows: list[tuple] = []
            for doc, text in zip(batch["doc_id"].to_pylist(), as_bytes(batch["text"])):
                keys = list(_keys(text, min_chars))
                rows += [(doc, keys[i]) for i in np.flatnonzero(found.value.has(_hashes(keys)))]
            if rows:
                ids, keys = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.binary())], ["doc_id", "key"])

    # Copies of a row, and a hot line, spread by (key, document); counting then combines in every task.
    held = texts.mapInArrow(suspects, "doc_id long, key binary").distinct()
    counted = held.groupBy("key").agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper"))
    # Stored, the exact counts are a plain scan: adaptive execution can then split a hot line's join.
    shared = stored(counted.where(F.col("n") >= min_docs).select("key", "keeper"))
    lost = held.join(shared, "key").where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    return lost.groupBy("doc_id").agg(F.collect_set("key").alias("keys"))


def without_shared_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, bits_log2: int = BITS_LOG2) -> DataFrame:
    """One row per document: `row` (its other columns), `text` without the lost lines, `n_lines`, `n_dropped`.

    Kept lines are joined by a newline as they were. A null text stays null with one line. Columns of
    any name may be present: they stay inside `row`. See `shared_lines` for odd rows.
    """
    lost = shared_lines(docs, min_chars, min_docs, bits_log2)
    row = F.struct(*[c for c in docs.columns if c != "text"]).alias("row")
    # Documents that lose nothing meet no partner; the text moves once.
    both = docs.select(F.col("doc_id").cast("long").alias("_id"), row, F.col("text").cast("string").alias("text")).join(
        lost.select(F.col("doc_id").alias("_lost"), "keys"), F.col("_id").eqNullSafe(F.col("_lost")), "left"
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_parts(batches):
            texts, n_lines, n_dropped = [], [], []
            for text, keys in zip(as_bytes(batch["text"]), batch["keys"].to_pylist()):
                lines = (text or b"").split(b"\n")
                n_lines.append(len(lines))
                if keys:
                    gone = set(keys)
                    kept = [x for x in lines if line_key(x) not in gone]
                    texts.append(b"\n".join(kept).decode())
                    n_dropped.append(len(lines) - len(kept))
                else:
                    texts.append(text if text is None else text.decode())
                    n_dropped.append(0)
            yield pa.RecordBatch.from_arrays(
                [batch["row"], pa.array(texts, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                ["row", "text", "n_lines", "n_dropped"],
            )

    both = both.select("row", "text", "keys")
    schema = with_fields(both.drop("keys").schema, n_lines="long", n_dropped="long")
    return both.mapInArrow(cut, schema)


def dedup_lines(docs: DataFrame, **options) -> DataFrame:
    """The documents with their shared lines removed; all columns stay, no row goes."""
    cut = without_shared_lines(docs, **options)
    return cut.select(*[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])


_SPACES = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

SQL = f"""
WITH l AS (SELECT doc_id, i, lines[i] AS line,
    translate(trim(lines[i], {_SPACES}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents))),
s AS (SELECT k, max(doc_id) AS keeper FROM l WHERE length(k) >= {MIN_CHARS} GROUP BY k HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
j AS (SELECT doc_id, i, line, keeper IS NOT NULL AND doc_id <> keeper AS gone FROM l LEFT JOIN s ON l.k = s.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""


@query(SQL)
def op4_line_dedup(spark, sf_dir):
    """Every line of every document."""
    cut = without_shared_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select(
        F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )

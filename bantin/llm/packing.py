"""Best-fit packing: plan sequences over the histogram of lengths, then give each document its slot.

The plan is best-fit decreasing, done for whole counts at once: all open sequences with the same
room are one entry, so the driver handles lengths (at most `capacity`), never documents. Documents
take the planned slots by their rank among those of equal length.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bantin.llm.common import as_bytes, query, release, small_parts, stored, table, whole_text, with_fields
from bantin.llm.tokenise import default_tokenizer, encoder

CAPACITY = 4096
END_ID = 1
# Pieces ranked in one window partition, on average.
_PER_BUCKET = 2_000

PLAN_COLUMNS = ["length", "first_rank", "n", "first_sequence", "each", "offset"]


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first_rank, n, first_sequence, each, offset).

    In a run, ranks first_rank .. first_rank + n - 1 of a length go to neighbouring sequences from
    `first_sequence` on, `each` to a sequence, side by side from `offset`. Longest first, every piece
    goes to the open sequence with the least room that holds it, else to a new one.

    A length splits at most one block of sequences with equal room and opens at most two, so there
    are at most 3 * capacity blocks; a length that uses a block leaves it less than half its room. So
    there are at most 3 * capacity * log2(capacity) runs, 150,000 for 4096, however many pieces.
    """
    runs: list[tuple[int, int, int, int, int, int]] = []
    blocks: dict[int, list[tuple[int, int]]] = {}
    rooms: list[int] = []
    sequences = 0

    def put(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in blocks:
                blocks[room] = []
                bisect.insort(rooms, room)
            blocks[room].append((first, n))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, n = blocks[room].pop()
                if not blocks[room]:
                    del blocks[room]
                    rooms.pop(at)
            else:
                room, first, n = capacity, sequences, -(-left // (capacity // length))
                sequences += n
            each = room // length
            full = min(n, left // each)
            if full:
                runs.append((length, rank, full * each, first, each, capacity - room))
                put(room - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            if left and full < n:
                runs.append((length, rank, left, first + full, left, capacity - room))
                put(room - left * length, first + full, 1)
                full, left = full + 1, 0
            put(room, first + full, n - full)
    return runs


def _cut(path: str, capacity: int, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for batch in small_parts(batches):
            rows: list[tuple] = []
            for doc, ids in zip(batch["doc_id"].to_pylist(), encode(as_bytes(batch["text"]), end_id)):
                ids = ids.astype("<u4")
                for k, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity].tobytes()
                    rows.append((doc, k, start, len(part) // 4, zlib.crc32(part), part if with_ids else None))
            if rows:
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32", "ids"])
        release()

    return run


def pieces(
    docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, tokenizer: str | None = None, with_ids: bool = False
) -> DataFrame:
    """Every document's ids and `end_id`, cut every `capacity` ids: doc_id, piece, start, length, ids_crc32.

    A null text is empty and has the end id alone. Repeated rows are packed each on its own, a null
    doc_id like any other. With `with_ids` also `ids`, little-endian unsigned 32-bit.
    """
    out = docs.select(F.col("doc_id").cast("long"), whole_text().alias("text")).mapInArrow(
        _cut(tokenizer or default_tokenizer(), capacity, end_id, with_ids),
        "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary",
    )
    return out if with_ids else out.drop("ids")


def pack(
    docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, tokenizer: str | None = None, with_ids: bool = False
) -> DataFrame:
    """The pieces with `sequence_id` and `offset`, their place in the packed sequences. See `pieces`."""
    # The texts are tokenized once; ranks and histogram must come from one version of the rows.
    cut = stored(pieces(docs, capacity, end_id, tokenizer, with_ids))
    lengths = {r.length: r.n for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = np.array(plan(lengths, capacity), np.int64).reshape(-1, len(PLAN_COLUMNS))
    runs = docs.sparkSession.sparkContext.broadcast(runs[np.lexsort((runs[:, 1], runs[:, 0]))])

    # A length may hold a third of all pieces: ranks are counted within buckets, which follow each other.
    buckets = max(1, sum(lengths.values()) // _PER_BUCKET)
    dealt = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).cast("int"))
    counts = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = dealt.withColumn("place", F.row_number().over(inside) - 1).join(bases, ["length", "bucket"])
    names = list(cut.columns)
    ranked = ranked.select(*names, (F.col("base") + F.col("place")).alias("rank"))

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, first_rank, _, first_sequence, each, offset = runs.value.T
        keys = (length << 48) + first_rank
        for batch in batches:
            own, rank = (batch[c].to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            at = np.searchsorted(keys, (own << 48) + rank, "right") - 1
            inside_run = rank - first_rank[at]
            columns = [batch[c] for c in names]
            columns += [pa.array(first_sequence[at] + inside_run // each[at]), pa.array(offset[at] + inside_run % each[at] * own)]
            yield pa.RecordBatch.from_arrays(columns, [*names, "sequence_id", "offset"])

    return ranked.mapInArrow(slots, with_fields(cut.schema, sequence_id="long", offset="long"))


def sequences(packed: DataFrame) -> DataFrame:
    """Whole sequences from `pack(..., with_ids=True)`: sequence_id, ids (32-bit), and its pieces in order."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "length", "ids")))
    rows = packed.groupBy("sequence_id").agg(inside.alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda total, p: F.concat(total, p["ids"]))
    return rows.select(
        "sequence_id", joined.alias("ids"),
        F.transform("parts", lambda p: F.struct(p["doc_id"], p["piece"], p["offset"], p["length"])).alias("pieces"),
    )


@query()
def op6_best_fit_packing(spark, sf_dir):
    """All documents in sequences of at most 4096 ids."""
    return pack(table(spark, sf_dir, "documents"))

"""Phrase collocation mining: exact counts of frequent n-grams in mergeable quotient filters.

1. Tasks read their texts once, in chunks of about CHUNK words, into local word numbers and a dictionary
   of what the chunk holds. The dictionaries, not the words, are added up by language and word.
2. Words that occur MIN_COUNT times or more get dense numbers, which a join brings back to the chunks. A
   phrase is as rare as its rarest word, so any other word ends a phrase.
3. A chunk packs the numbers of 2 or 3 neighbouring words into one value, permutes it by a Feistel
   network, which is a bijection of values of that width, and counts equal ones. The permuted value is
   stored as a quotient (unary, about two bits) and the full rest, so nothing is lost and two phrases
   never share a counter. Leading bits name the shard.
4. A shard's filters are sorted, and are merged into one. Only frequent values are turned back into word
   numbers; scores, cuts and the rule of longer phrases are joins of these.

The number of shards follows the number of words, so that one shard stays small; what a chunk sends is
never more rows than it has different phrases.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bantin.llm.common import as_bytes, mixed, query, stored, table, whole_text

MIN_COUNT, COVERED_PERCENT, TOP = 10, 50, 2_000
SCORE_SCALE = 1_000_000
CHUNK = 2_000_000
SHARD = 500_000
_NUMBERED = 50_000
_SLICE_BYTES = 4 << 20
_MARK = b"\xff"  # a byte that UTF-8 never has ends a piece
_ENDS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", _MARK * 10)
_CUT = re.compile(rb"[\x20\x09-\x0D.,;:!?]")


# --- chunks -----------------------------------------------------------------------------


def _slices(text: bytes) -> Iterator[bytes]:
    """The text in parts that begin at a space or the end of a piece."""
    at = 0
    while len(text) - at > _SLICE_BYTES:
        found = _CUT.search(text, at + _SLICE_BYTES)
        if not found:
            break
        yield text[at : found.start()]
        at = found.start()
    yield text[at:]


class _Chunk:
    """Words of several texts as local numbers; 0 ends a piece."""

    def __init__(self) -> None:
        self.parts: list[np.ndarray] = []
        self.size = 0
        self.numbers: dict[str, dict[bytes, int]] = {}
        self.words: list[tuple[str, bytes]] = []

    def add(self, lang: str, text: bytes) -> None:
        known = self.numbers.setdefault(lang, {_MARK: 0})
        for part in _slices(text):
            words = part.lower().translate(_ENDS).replace(_MARK, b" \xff ").split()
            new = set(words).difference(known)
            for word in new:
                self.words.append((lang, word))
                known[word] = len(self.words)
            self.parts.append(np.fromiter(map(known.__getitem__, words), np.uint32, len(words)))
            self.size += len(words)
        self.parts.append(np.zeros(1, np.uint32))
        self.size += 1

    def row(self, number: int) -> pa.RecordBatch:
        tokens = np.concatenate(self.parts)
        counts = np.bincount(tokens, minlength=len(self.words) + 1)[1:]
        langs, words = zip(*self.words) if self.words else ((), ())
        entry = pa.StructArray.from_arrays(
            [pa.array(langs, pa.string()), pa.array(words, pa.binary()).view(pa.string()), pa.array(counts, pa.int64())], ["lang", "word", "n"]
        )
        entries = pa.ListArray.from_arrays(pa.array([0, len(entry)], pa.int32()), entry)
        packed = zstandard.ZstdCompressor(level=1).compress(tokens.tobytes())
        columns = [pa.array([number], pa.int64()), pa.array([len(tokens)], pa.int64()), pa.array([packed], pa.binary()), entries]
        return pa.RecordBatch.from_arrays(columns, ["chunk", "size", "tokens", "dictionary"])


def _chunks(docs: DataFrame, chunk: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, made, current = TaskContext.get().partitionId() << 32, 0, _Chunk()
        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), as_bytes(batch["text"])):
                current.add(lang, text)
                if current.size >= chunk:
                    yield current.row(first + made)
                    made, current = made + 1, _Chunk()
        if current.size:
            yield current.row(first + made)

    return docs.mapInArrow(run, "chunk long, size long, tokens binary, dictionary array<struct<lang:string,word:string,n:long>>")


# --- counting quotient filters ----------------------------------------------------------


class Packing:
    """Values of `order` word numbers below 2^bits, as two halves, and their permutation."""

    _KEYS = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]

    def __init__(self, order: int, bits: int) -> None:
        self.order, self.bits, self.half = order, bits + bits % 2, order * (bits + bits % 2) // 2
        if self.half > 64:
            raise ValueError(f"{order} words of {bits} bits do not fit into 128 bits")

    def pack(self, ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        if self.order == 2:
            return ids[0], ids[1]
        middle, b = np.uint64(self.bits // 2), np.uint64(self.bits)
        low = ids[1] & np.uint64((1 << self.bits // 2) - 1)
        return ids[0] << middle | ids[1] >> middle, low << b | ids[2]

    def unpack(self, high: np.ndarray, low: np.ndarray) -> list[np.ndarray]:
        if self.order == 2:
            return [high, low]
        middle, b = np.uint64(self.bits // 2), np.uint64(self.bits)
        mask = np.uint64((1 << self.bits // 2) - 1)
        return [high >> middle, (high & mask) << middle | low >> b, low & np.uint64((1 << self.bits) - 1)]

    def _round(self, x: np.ndarray, key: np.uint64) -> np.ndarray:
        return mixed(x ^ key) >> np.uint64(64 - self.half)

    def permute(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for key in self._KEYS:
            high, low = low, high ^ self._round(low, key)
        return high, low

    def restore(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for key in reversed(self._KEYS):
            high, low = low ^ self._round(high, key), high
        return high, low


def summed(high: np.ndarray, low: np.ndarray, counts: np.ndarray | None, half: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different values in order, and the sum of their counts (None: one each)."""
    if not len(high):
        return high, low, np.empty(0, np.int64)
    if 2 * half <= 64:
        keys = high << np.uint64(half) | low
        if counts is None:
            keys, counts = np.unique(keys, return_counts=True)
        else:
            order = np.argsort(keys, kind="stable")  # merges the runs that are sorted already
            keys = keys[order]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            keys, counts = keys[first], np.add.reduceat(counts[order], first)
        return keys >> np.uint64(half), keys & np.uint64((1 << half) - 1), counts.astype(np.int64)
    order = np.lexsort((low, high))
    high, low = high[order], low[order]
    first = np.flatnonzero(np.concatenate([[True], (high[1:] != high[:-1]) | (low[1:] != low[:-1])]))
    counts = np.diff(np.append(first, len(high))) if counts is None else np.add.reduceat(counts[order], first)
    return high[first], low[first], counts.astype(np.int64)


_HEAD = struct.Struct("<IB")


def _as_columns(values: np.ndarray, n_bits: int) -> bytes:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : -(-n_bits // 8)].tobytes()


def _from_columns(data: bytes, at: int, n: int, n_bits: int) -> tuple[np.ndarray, int]:
    width = -(-n_bits // 8)
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8, n * width, at).reshape(n, width)
    return out.view("<u8").ravel(), at + n * width


def write_filter(high: np.ndarray, low: np.ndarray, counts: np.ndarray, half: int, known_bits: int) -> bytes:
    """A filter of sorted values that agree in their `known_bits` leading bits."""
    n, free = len(high), half - known_bits
    q = min(free, max(0, n.bit_length() - 1))
    rest = free - q
    own = high & np.uint64((1 << free) - 1)
    # Quotients in unary: a one for each value, a zero after each quotient.
    bits = np.zeros(n + (1 << q), np.uint8)
    bits[(own >> np.uint64(rest)).astype(np.int64) + np.arange(n)] = 1
    tail = own & np.uint64((1 << rest) - 1)
    if rest + half <= 64:
        columns = _as_columns(tail << np.uint64(half) | low if half < 64 else low, rest + half)
    else:
        columns = _as_columns(tail, rest) + _as_columns(low, half)
    large = counts >= 255
    return b"".join([
        _HEAD.pack(n, q), np.packbits(bits).tobytes(), columns,
        np.where(large, 255, counts).astype(np.uint8).tobytes(), counts[large].astype("<i8").tobytes(),
    ])


def read_filter(data: bytes, half: int, known_bits: int, known: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The values and counts that `write_filter` wrote; `known` are their leading bits."""
    n, q = _HEAD.unpack_from(data)
    free = half - known_bits
    rest, at = free - q, _HEAD.size
    n_bytes = -(-(n + (1 << q)) // 8)
    quotient = np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, n_bytes, at))[: n + (1 << q)]) - np.arange(n)
    at += n_bytes
    if rest + half <= 64:
        both, at = _from_columns(data, at, n, rest + half)
        tail, low = (both >> np.uint64(half), both & np.uint64((1 << half) - 1)) if half < 64 else (np.zeros(n, np.uint64), both)
    else:
        tail, at = _from_columns(data, at, n, rest)
        low, at = _from_columns(data, at, n, half)
    counts = np.frombuffer(data, np.uint8, n, at).astype(np.int64)
    large = counts == 255
    counts[large] = np.frombuffer(data, "<i8", int(large.sum()), at + n)
    high = np.uint64(known << free if free < 64 else 0) | quotient.astype(np.uint64) << np.uint64(rest) | tail
    return high, low, counts


def _filters(mapped: DataFrame, bits: int, shard_bits: int, chunk: int) -> DataFrame:
    """One filter per chunk, order and shard."""
    packings = [Packing(order, bits) for order in (2, 3)]

    def of(ids: np.ndarray, at: int) -> Iterator[pa.RecordBatch]:
        for packing in packings:
            end = max(at, min(at + chunk, len(ids) - packing.order + 1))
            neighbours = [ids[at + k : end + k] for k in range(packing.order)]
            whole = np.logical_and.reduce([x > 0 for x in neighbours])
            high, low = packing.permute(*packing.pack([x[whole] for x in neighbours]))
            high, low, counts = summed(high, low, None, packing.half)
            known = min(shard_bits, packing.half)
            shards = high >> np.uint64(packing.half - known)
            first = np.flatnonzero(np.concatenate([[True], shards[1:] != shards[:-1]])) if len(high) else []
            names, blobs = [], []
            for a, b in zip(first, [*first[1:], len(high)]):
                names.append(int(shards[a]))
                blobs.append(write_filter(high[a:b], low[a:b], counts[a:b], packing.half, known))
            columns = [pa.array([packing.order] * len(names), pa.int32()), pa.array(names, pa.int64()), pa.array(blobs, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["order", "shard", "filter"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                tokens = np.frombuffer(zstandard.ZstdDecompressor().decompress(batch["tokens"][i].as_py()), np.uint32)
                pairs = batch["numbers"][i].values
                ids = np.zeros(int(tokens.max()) + 1, np.uint64)
                ids[pairs.field("local").to_numpy()] = pairs.field("id").to_numpy().astype(np.uint64)
                # A chunk that one long text has filled beyond its size goes in parts.
                ids = ids[tokens]
                for at in range(0, len(ids), chunk):
                    yield from of(ids, at)

    return mapped.mapInArrow(run, "order int, shard long, filter binary")


def _frequent(filters: DataFrame, bits: int, shard_bits: int, min_count: int) -> DataFrame:
    """order, a, b, c (0 for two words) and f of the n-grams counted `min_count` times or more."""
    packings = {order: Packing(order, bits) for order in (2, 3)}

    def answer(order: int, held: list[tuple]) -> pa.RecordBatch:
        packing = packings[order]
        high, low, counts = summed(*(np.concatenate(x) for x in zip(*held)), packing.half)
        often = counts >= min_count
        ids = packing.unpack(*packing.restore(high[often], low[often]))
        ids = [x.astype(np.int64) for x in ids] + [np.zeros(int(often.sum()), np.int64)] * (3 - order)
        columns = [pa.array([order] * len(ids[0]), pa.int32()), *map(pa.array, ids), pa.array(counts[often])]
        return pa.RecordBatch.from_arrays(columns, ["order", "a", "b", "c", "f"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            for row in zip(batch["order"].to_pylist(), batch["shard"].to_pylist(), batch["filter"].to_pylist()):
                if row[:2] != key:
                    if held:
                        yield answer(key[0], held)
                    key, held = row[:2], []
                half = packings[row[0]].half
                held.append(read_filter(row[2], half, min(shard_bits, half), row[1]))
                if len(held) > 64:  # what has been read so far becomes one filter
                    held = [summed(*(np.concatenate(x) for x in zip(*held)), half)]
        if held:
            yield answer(key[0], held)

    dealt = filters.repartition("order", "shard").sortWithinPartitions("order", "shard")
    return dealt.mapInArrow(run, "order int, a long, b long, c long, f long")


# --- words and scores -------------------------------------------------------------------


def _numbered(words: DataFrame) -> tuple[DataFrame, int]:
    """The words with dense numbers from 1, and how many there are."""
    total = words.count()
    dealt = words.withColumn("_part", F.pmod(F.xxhash64("lang", "word"), F.lit(total // _NUMBERED + 1)))
    placed = stored(dealt.withColumn("_place", F.row_number().over(Window.partitionBy("_part").orderBy("lang", "word"))))
    offsets, before = [], 0
    for r in sorted(placed.groupBy("_part").count().collect()):
        offsets.append((r["_part"], before))
        before += r["count"]
    known = words.sparkSession.createDataFrame(offsets, "_part long, _before long")
    numbered = placed.join(F.broadcast(known), "_part").select("lang", "word", "f", (F.col("_before") + F.col("_place")).alias("id"))
    return stored(numbered), total


def _score(l: Column, r: Column) -> Column:  # noqa: E741
    wide = lambda c: c.cast("decimal(19,0)")
    over = F.lit(SCORE_SCALE).cast("decimal(7,0)") * wide(F.col("a")) * wide(F.col("a"))
    return F.call_function("div", over, wide(l) * wide(r))


def collocations(
    docs: DataFrame, min_count: int = MIN_COUNT, covered_percent: int = COVERED_PERCENT, top: int = TOP, chunk: int = CHUNK, shard: int = SHARD
) -> DataFrame:
    """The best phrases of 2 and 3 words of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z) and split into pieces at .,;:!? and line ends, and into words at spaces and
    tabs. A phrase with a = f(phrase) >= min_count is cut into two parts that occur l and r times; its
    score is floor(1,000,000 a a / (l r)) for the lowest cut, the first of equal ones. A phrase inside a
    longer candidate that occurs at least covered_percent % as often is dropped. A null lang counts as
    `und` (and is one with it), a null text as empty; repeated rows count each. Languages without
    candidates give no rows. Other columns are not looked at. A value holds 128 bits, so there may be
    2^42 frequent words.
    """
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), whole_text().alias("text"))
    chunks = stored(_chunks(texts, chunk))
    held = chunks.select("chunk", F.posexplode("dictionary").alias("local", "entry")).select(
        "chunk", (F.col("local") + 1).alias("local"), "entry.lang", "entry.word", "entry.n"
    )
    totals = held.groupBy("lang").agg(F.sum("n").alias("n"))
    words, total = _numbered(stored(held.groupBy("lang", "word").agg(F.sum("n").alias("f")).where(F.col("f") >= min_count)))
    bits = max(2, total.bit_length())
    size = chunks.agg(F.sum("size")).first()[0] or 0
    shard_bits = max(0, (size // shard).bit_length())

    numbers = held.join(words, ["lang", "word"]).groupBy("chunk").agg(F.collect_list(F.struct("local", "id")).alias("numbers"))
    filters = _filters(chunks.select("chunk", "tokens").join(numbers, "chunk").select("tokens", "numbers"), bits, shard_bits, chunk)
    grams = stored(_frequent(filters, bits, shard_bits, min_count))

    one = lambda k: words.select(F.col("id").alias(k), F.col("f").alias(f"f_{k}"), F.col("word").alias(f"w_{k}"), F.col("lang").alias(f"lang_{k}"))
    two = grams.where("order = 2").select("a", "b", "f")
    three = grams.where("order = 3").select("a", "b", "c", "f")
    longer = three.select("a", "b", "f").unionByName(three.select(F.col("b").alias("a"), F.col("c").alias("b"), "f"))
    longer = longer.groupBy("a", "b").agg(F.max("f").alias("longest"))
    pairs = two.join(longer, ["a", "b"], "left").where(F.col("longest").isNull() | (100 * F.col("longest") < covered_percent * F.col("f")))
    pairs = pairs.join(one("a").withColumnRenamed("lang_a", "lang"), "a").join(one("b").drop("lang_b"), "b").select(
        "lang", F.concat_ws(" ", "w_a", "w_b").alias("phrase"), F.col("f").alias("a"), F.array(F.struct(F.col("f_a").alias("l"), F.col("f_b").alias("r"))).alias("cuts")
    )
    triples = three.join(two.withColumnRenamed("f", "f_ab"), ["a", "b"]).join(two.select(F.col("a").alias("b"), F.col("b").alias("c"), F.col("f").alias("f_bc")), ["b", "c"])
    triples = triples.join(one("a").withColumnRenamed("lang_a", "lang"), "a").join(one("b").drop("lang_b"), "b").join(one("c").drop("lang_c"), "c").select(
        "lang",
        F.concat_ws(" ", "w_a", "w_b", "w_c").alias("phrase"),
        F.col("f").alias("a"),
        F.array(F.struct(F.col("f_a").alias("l"), F.col("f_bc").alias("r")), F.struct(F.col("f_ab").alias("l"), F.col("f_c").alias("r"))).alias("cuts"),
    )
    scored = pairs.unionByName(triples).select("lang", "phrase", "a", F.posexplode("cuts").alias("k", "cut")).select("lang", "phrase", "a", "k", "cut.l", "cut.r")
    scored = scored.withColumn("score", _score(F.col("l"), F.col("r")))
    least = F.min(F.struct("score", "k", "l", "r"))
    best = scored.groupBy("lang", "phrase", "a").agg(least.alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(F.broadcast(totals), "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


SQL = rf"""
WITH pieces AS (SELECT doc_id, coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
g1 AS (SELECT lang, unnest(w) AS p FROM w),
f1 AS MATERIALIZED (SELECT lang, p, count(*) AS f FROM g1 GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f1 GROUP BY ALL),
g2 AS (SELECT lang, w[i] AS w1, w[i + 1] AS w2 FROM (SELECT lang, w, unnest(range(1, len(w))) AS i FROM w)),
f2 AS MATERIALIZED (SELECT lang, w1, w2, count(*) AS f FROM g2 GROUP BY ALL HAVING count(*) >= {MIN_COUNT}),
g3 AS (SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3 FROM (SELECT lang, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
f3 AS MATERIALIZED (SELECT lang, w1, w2, w3, count(*) AS f FROM g3 GROUP BY ALL HAVING count(*) >= {MIN_COUNT}),
c AS (SELECT f2.lang, w1 || ' ' || w2 AS phrase, f2.f AS a, 1 AS k, x.f AS l, y.f AS r FROM f2
    JOIN f1 x ON x.lang = f2.lang AND x.p = w1 JOIN f1 y ON y.lang = f2.lang AND y.p = w2
    WHERE NOT EXISTS (SELECT 1 FROM f3 WHERE f3.lang = f2.lang AND 100 * f3.f >= {COVERED_PERCENT} * f2.f
      AND (f3.w1 = f2.w1 AND f3.w2 = f2.w2 OR f3.w2 = f2.w1 AND f3.w3 = f2.w2))
  UNION ALL SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || w3, f3.f, 1, x.f, y.f FROM f3
    JOIN f1 x ON x.lang = f3.lang AND x.p = f3.w1 JOIN f2 y ON y.lang = f3.lang AND y.w1 = f3.w2 AND y.w2 = w3
  UNION ALL SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || w3, f3.f, 2, x.f, y.f FROM f3
    JOIN f2 x ON x.lang = f3.lang AND x.w1 = f3.w1 AND x.w2 = f3.w2 JOIN f1 y ON y.lang = f3.lang AND y.p = w3),
s AS (SELECT *, ({SCORE_SCALE}::HUGEINT * a * a // (l::HUGEINT * r))::BIGINT AS score FROM c),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b)
SELECT lang, rank, phrase, a, l, r, n, score FROM o JOIN n USING (lang) WHERE rank <= {TOP}
"""


@query(SQL)
def op13_collocations(spark, sf_dir):
    """The 2000 best phrases of each language."""
    return collocations(table(spark, sf_dir, "documents"))

"""LM scoring: a bigram model whose counts live in one log-frequency Bloom filter.

An n-gram with count c is put in as events (n-gram, 1) .. (n-gram, level(c)), where levels grow with
the logarithm of the count. A count is read back by probing level after level until one is missing;
a bigram is never given more than either of its words has. Words and bigrams share the filter.

Probabilities are interpolated by Witten and Bell's rule: a context seen c times with t different
followers gives weight t / (c + t) to the word alone. Contexts of one level share the ratio of t to c,
summed over all their bigrams; a word alone is smoothed in the same way to a uniform distribution.

Counting covers all training texts: word counts are exact (64-bit hashes of words), bigrams are
shuffled as compressed runs of 48-bit hashes, and every block of the hash space builds its own part
of the filter with about 8 to 16 bits an event, however many blocks there are.

Scoring never holds the whole filter. Texts are gathered to chunks; a chunk sends each distinct key
once to the group of blocks that has it, a group answers with levels, and the answers meet the chunk
again. `max_bytes` bounds a group, and scores do not depend on it. `train` makes a model for one
process instead: there a filter above `max_bytes` is folded in halves, which never drops an n-gram,
but raises the rate of false hits, which `Filter.fill` tells.

The plain baseline needs every word's exact count. The most frequent words, at most `max_words`, are
broadcast; all others are looked up by a join with the table of counts, however many there are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bantin.llm.common import WORD_HASHES, as_bytes, mixed, query, release, stored, table, whole_text

# The filter as held by one task, and the words broadcast with exact counts (16 bytes each).
MAX_BYTES = 64 << 20
MAX_WORDS = 1_000_000
# Levels per doubling of a count, and probes per event.
_PER_DOUBLING = 2
_PROBES = 4
_BITS_PER_EVENT = 8
_KEY_BITS = 48
# N-grams held by a task before they go on, and about as many per block of the hash space.
_HELD = 2_000_000
_PER_BLOCK = 200_000
_SLICE_BYTES = 4 << 20
_PART_BYTES = 256 << 10
# Tokens of a chunk when scoring, and training tokens for each group of blocks; there are at least 64 groups.
_CHUNK = 1_000_000
_PER_GROUP = 16_000_000
_LEVELS = 128

# Stands for the end of a text, and before its first word; it has a space, so it is no word.
END = np.uint64(0x2545F4914F6CDD1D)


def level_of(counts: np.ndarray) -> np.ndarray:
    """1 for a count of 1, and so on up by the logarithm; 0 for none."""
    with np.errstate(divide="ignore"):
        return np.where(counts > 0, 1 + np.floor(_PER_DOUBLING * np.log2(np.maximum(counts, 1)) + 1e-9), 0).astype(np.int64)


def _expected() -> np.ndarray:
    """The middle of the counts of each level."""
    edges = np.ceil(2.0 ** (np.arange(_LEVELS) / _PER_DOUBLING) - 1e-9)
    return np.concatenate([[0.0], (edges[:-1] + np.maximum(edges[1:] - 1, edges[:-1])) / 2])


_EXPECTED = _expected()


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of the batches: their rows, the hashes of all tokens, and the number of tokens of each row.

    Words are Python objects for `_PART_BYTES` of text at a time, and numbers from then on.
    """
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch["text"]).to_numpy())
        at, held, first = 0, [], 0
        while at < len(batch):
            start = ends[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(ends, start + _PART_BYTES, "right")))
            held.append(_tokens(as_bytes(batch["text"].slice(at, end - at))))
            if end == len(batch) or ends[end - 1] - (ends[first - 1] if first else 0) >= _SLICE_BYTES:
                yield batch.slice(first, end - first), *merged_parts(held)
                first = end
            at = end


def _tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of the texts, and the number of tokens of each."""
    words = [t.lower().split() for t in texts]
    sizes = np.array([len(w) + 1 for w in words])
    tokens = np.full(sizes.sum(), END, np.uint64)
    is_word = np.ones(len(tokens), bool)
    is_word[np.cumsum(sizes) - 1] = False
    tokens[is_word] = WORD_HASHES.of([w for x in words for w in x])
    return tokens, sizes


def merged_parts(held: list[tuple]) -> list[np.ndarray]:
    """The arrays of all parts, joined place by place; the list is emptied, so that no part stays in memory."""
    out = [np.concatenate(x) for x in zip(*held)]
    held.clear()
    return out


def _word_keys(words: np.ndarray) -> np.ndarray:
    return mixed(words ^ np.uint64(0x1B873593CC9E2D51)) >> np.uint64(64 - _KEY_BITS)


def _bigram_keys(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    return mixed(mixed(before) + words * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _KEY_BITS)


def _contexts(tokens: np.ndarray) -> np.ndarray:
    """The token before each; the first of a text follows the END of the one before."""
    return np.concatenate([[END], tokens[:-1]])


# --- counting --------------------------------------------------------------------------

def word_counts(texts: DataFrame) -> DataFrame:
    """word (64-bit hash) and c, of all tokens; counts are combined within tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, tokens, _ in _slices(batches):
            words, c = np.unique(tokens, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(c, pa.int64())], ["word", "c"])

    return texts.mapInArrow(run, "word long, c long").groupBy("word").agg(F.sum("c").alias("c"))


class FrequentWords:
    """Exact counts of the words that are frequent enough to be broadcast."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, least: int) -> None:
        order = np.argsort(words)
        self.words, self.counts, self.least = words[order], counts[order], least

    def __call__(self, words: np.ndarray) -> np.ndarray:
        """Counts; 0 for words that are not among them."""
        if not len(self.words):
            return np.zeros(len(words), np.int64)
        at = np.searchsorted(self.words, words)
        at[at == len(self.words)] = 0
        return np.where(self.words[at] == words, self.counts[at], 0)


def frequent_words(counts: DataFrame, max_words: int) -> FrequentWords:
    """All words with a count of at least some power of two, so chosen that there are at most `max_words`."""
    sizes = counts.groupBy(F.floor(F.log2("c") + 1e-9).cast("int").alias("k")).agg(F.count("*").alias("n")).collect()
    least, total = 62, 0
    for k, n in sorted(((r.k, r.n) for r in sizes), reverse=True):
        total += n
        if total > max_words:
            break
        least = k
    rows = counts.where(F.col("c") >= F.lit(float(1 << least))).toArrow()
    return FrequentWords(rows["word"].to_numpy().view(np.uint64), rows["c"].to_numpy(), 1 << least)


def _packed(keys: np.ndarray, counts: np.ndarray, classes: np.ndarray) -> bytes:
    """Sorted keys as differences, with counts and classes, byte plane by byte plane."""
    planes = [np.diff(keys, prepend=np.uint64(0)).astype("<u8"), counts.astype("<u8"), classes.astype("<u1")]
    return zstandard.compress(b"".join(p.view(np.uint8).reshape(len(keys), -1).T.tobytes() for p in planes), 1)


def _unpacked(data: bytes) -> tuple[np.ndarray, ...]:
    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    n = len(raw) // 17
    wide = lambda a: np.ascontiguousarray(raw[a * n : (a + 8) * n].reshape(8, n).T).view("<u8").ravel()
    return np.cumsum(wide(0), dtype=np.uint64), wide(8), raw[16 * n :]


def _by_block(keys: np.ndarray, counts: np.ndarray, classes: np.ndarray, block_bits: int) -> Iterator[pa.RecordBatch]:
    """Rows (block, run) of n-grams; equal keys are combined first."""
    order = np.argsort(keys)
    keys, counts, classes = keys[order], counts[order], classes[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    if not len(first):
        return
    keys, classes, counts = keys[first], classes[first], np.add.reduceat(counts, first)
    blocks = (keys >> np.uint64(_KEY_BITS - block_bits)).astype(np.int64)
    starts = np.flatnonzero(np.concatenate([[True], blocks[1:] != blocks[:-1]]))
    ends = np.append(starts[1:], len(keys))
    for a in range(0, len(starts), 2_000):
        some = range(a, min(a + 2_000, len(starts)))
        runs = [_packed(keys[starts[i] : ends[i]], counts[starts[i] : ends[i]], classes[starts[i] : ends[i]]) for i in some]
        yield pa.RecordBatch.from_arrays([pa.array(blocks[starts[some.start : some.stop]]), pa.array(runs, pa.binary())], ["block", "run"])


def _ngram_runs(texts: DataFrame, counts: DataFrame, frequent, block_bits: int) -> DataFrame:
    """Runs of all bigrams of the texts, with the class of their contexts, and of all words."""

    def gathered(parts: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        """A task's n-grams together, so that it sends each block a few long runs."""
        held, n = [], 0
        for part in parts:
            held.append(part)
            n += len(part[0])
            if n >= _HELD:
                del part
                yield from _by_block(*merged_parts(held), block_bits)
                n = 0
                release()
        if held:
            yield from _by_block(*merged_parts(held), block_bits)
        release()

    def bigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts() -> Iterator[tuple]:
            for _, tokens, _ in _slices(batches):
                contexts = _contexts(tokens)
                own, back = np.unique(contexts, return_inverse=True)
                classes = level_of(frequent.value(own)).astype(np.uint8)[back]
                yield _bigram_keys(contexts, tokens), np.ones(len(tokens), np.uint32), classes

        return gathered(parts())

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts() -> Iterator[tuple]:
            for batch in batches:
                keys = _word_keys(batch["word"].to_numpy().view(np.uint64))
                yield keys, batch["c"].to_numpy().astype(np.uint64), np.full(len(keys), _LEVELS, np.uint8)

        return gathered(parts())

    return texts.mapInArrow(bigrams, "block long, run binary").unionByName(counts.mapInArrow(words, "block long, run binary"))


# --- the filter ------------------------------------------------------------------------

def _probes(keys: np.ndarray, level: np.ndarray | int, mask: np.ndarray) -> Iterator[np.ndarray]:
    """Bit places within a block for the event (key, level)."""
    one = mixed(keys * np.uint64(0xFF51AFD7ED558CCD) + np.atleast_1d(np.asarray(level, np.uint64)) * np.uint64(0xC4CEB9FE1A85EC53))
    two = mixed(one) | np.uint64(1)
    for i in range(_PROBES):
        yield (one + np.uint64(i) * two) & mask


def _build(table_: pa.Table) -> pa.Table:
    """One block: its n-grams counted, quantised and put into a bit array; and the totals of its context classes."""
    merged = [np.concatenate(x) for x in zip(*map(_unpacked, table_["run"].to_pylist()))]
    order = np.argsort(merged[0])
    keys, counts, classes = (x[order] for x in merged)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    keys, counts, classes = keys[first], np.add.reduceat(counts, first).astype(np.int64), classes[first]
    levels = level_of(counts)
    bits = 1 << max(6, int(_BITS_PER_EVENT * levels.sum() - 1).bit_length())
    array = np.zeros(bits // 8, np.uint8)
    for level in range(1, int(levels.max()) + 1):
        for place in _probes(keys[levels >= level], level, np.uint64(bits - 1)):
            np.bitwise_or.at(array, (place >> np.uint64(3)).astype(np.int64), np.uint8(1) << (place & np.uint64(7)).astype(np.uint8))
    kinds = np.bincount(classes, minlength=_LEVELS + 1)[:_LEVELS]
    tokens = np.bincount(classes, weights=counts, minlength=_LEVELS + 1)[:_LEVELS]
    row = [table_["block"][0].as_py(), array.tobytes(), kinds.tolist(), tokens.astype(np.int64).tolist()]
    types = [pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    return pa.Table.from_arrays([pa.array([x], t) for x, t in zip(row, types)], names=["block", "bits", "kinds", "tokens"])


def _folded(bits: np.ndarray, folds: int) -> np.ndarray:
    for _ in range(folds):
        if len(bits) > 8:
            bits = bits[: len(bits) // 2] | bits[len(bits) // 2 :]
    return bits


class Filter:
    """The log-frequency Bloom filter: blocks of bits side by side."""

    def __init__(self, block_bits: int, blocks: dict[int, bytes]) -> None:
        self.block_bits = block_bits
        sizes = np.full(1 << block_bits, 8, np.int64)
        for b, data in blocks.items():
            sizes[b] = len(data)
        self.offset = np.cumsum(sizes) - sizes
        self.mask = (sizes * 8 - 1).astype(np.uint64)
        bits = np.zeros(sizes.sum(), np.uint8)
        for b, data in blocks.items():
            bits[self.offset[b] : self.offset[b] + len(data)] = np.frombuffer(data, np.uint8)
        self.bits = bits
        self.fill = float(np.bitwise_count(bits).sum()) / max(1, 8 * len(bits))

    def levels(self, keys: np.ndarray, most: np.ndarray) -> np.ndarray:
        """The level of each key, read by repeated probes; `most` bounds it from above."""
        out = np.zeros(len(keys), np.int64)
        block = (keys >> np.uint64(_KEY_BITS - self.block_bits)).astype(np.int64)
        offset, mask, at, level = self.offset[block], self.mask[block], np.flatnonzero(most > 0), 0
        while len(at):
            level += 1
            own, base, within = keys[at], offset[at], mask[at]
            hit = np.ones(len(at), bool)
            for place in _probes(own, level, within):
                hit &= (self.bits[base + (place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
            at = at[hit]
            out[at] = level
            at = at[most[at] > level]
        return out


class Model:
    """Smoothed log10 probabilities from probes of the filter."""

    def __init__(self, filter_: Filter, ratio: np.ndarray, least: int, n: int, v: int) -> None:
        self.filter, self.ratio, self.least, self.n, self.v = filter_, ratio, least, n, v

    def log_probabilities(self, tokens: np.ndarray) -> np.ndarray:
        words, back = np.unique(tokens, return_inverse=True)
        return self.of_places(words, back)

    def of_places(self, words: np.ndarray, back: np.ndarray) -> np.ndarray:
        """The same for tokens given as places in a list of distinct words."""
        tokens = words[back]
        word_levels = self.filter.levels(_word_keys(words), np.full(len(words), _LEVELS))
        alone = (_EXPECTED[word_levels] + self.v / (self.v + 1)) / (self.n + self.v)
        own = word_levels[back]
        first = self.filter.levels(_word_keys(np.array([END])), np.array([_LEVELS]))
        before = np.concatenate([first, own[:-1]])
        pair = self.filter.levels(_bigram_keys(_contexts(tokens), tokens), np.minimum(before, own))
        seen = _EXPECTED[before]
        # Contexts too rare to be broadcast are one class, 0.
        kinds = seen * self.ratio[np.where(before >= level_of(np.array([self.least]))[0], before, 0)]
        lower = alone[back]
        total = seen + kinds
        return np.log10(np.where(total > 0, (np.minimum(_EXPECTED[pair], seen) + kinds * lower) / np.where(total > 0, total, 1), lower))


class Counted(NamedTuple):
    """What was learned: tables of word counts and of the filter's blocks, `size` bytes in all, and the smoothing."""

    words: DataFrame
    frequent: FrequentWords
    blocks: DataFrame
    block_bits: int
    size: int
    ratio: np.ndarray
    n: int
    v: int


def count(texts: DataFrame, max_words: int = MAX_WORDS) -> Counted:
    """Counts of a frame with `text`; the filter stays in a stored table, block by block."""
    spark = texts.sparkSession
    counts = stored(word_counts(texts))
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    frequent = frequent_words(counts, max_words)
    block_bits = max(4, math.ceil(math.log2(max(1, n / _PER_BLOCK))))
    runs = _ngram_runs(texts, counts, spark.sparkContext.broadcast(frequent), block_bits)
    blocks = stored(runs.groupBy("block").applyInArrow(_build, "block long, bits binary, kinds array<long>, tokens array<long>"))
    size = blocks.agg(F.coalesce(F.sum(F.octet_length("bits")), F.lit(0))).first()[0]
    at = blocks.select(F.posexplode(F.arrays_zip("kinds", "tokens")).alias("class", "x"))
    totals = at.groupBy("class").agg(F.sum("x.kinds").alias("kinds"), F.sum("x.tokens").alias("tokens")).collect()
    ratio = np.full(_LEVELS + 1, sum(r.kinds for r in totals) / max(1, sum(r.tokens for r in totals)))
    for r in sorted((r for r in totals if r.tokens), key=lambda r: r["class"]):
        ratio[r["class"] :] = r.kinds / r.tokens  # a class that no context is in, as one hit too many makes it
    return Counted(counts, frequent, blocks.select("block", "bits"), block_bits, size, ratio, n, v)


def train(texts: DataFrame, max_bytes: int = MAX_BYTES, max_words: int = MAX_WORDS) -> tuple[DataFrame, FrequentWords, Model]:
    """The stored table of word counts, the frequent words, and a model to hold in one process, from a frame with `text`."""
    counted = count(texts, max_words)
    folds = max(0, math.ceil(math.log2(max(1, counted.size / max_bytes))))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [_folded(np.frombuffer(b, np.uint8), folds).tobytes() for b in batch["bits"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["block"], pa.array(bits, pa.binary())], ["block", "bits"])

    rows = counted.blocks.mapInArrow(fold, "block long, bits binary").toArrow()
    kept = Filter(counted.block_bits, dict(zip(rows["block"].to_pylist(), rows["bits"].to_pylist())))
    return counted.words, counted.frequent, Model(kept, counted.ratio, counted.frequent.least, counted.n, counted.v)


# --- scoring ---------------------------------------------------------------------------

class Answers:
    """Levels as the groups of blocks answered them, in place of a filter."""

    def __init__(self, keys: np.ndarray, levels: np.ndarray) -> None:
        self.keys, self.found = keys, levels

    def levels(self, keys: np.ndarray, most: np.ndarray) -> np.ndarray:
        """The level of each key, all of which were asked for; `most` bounds it from above."""
        order = np.argsort(keys)  # lookups in order are much quicker
        out = np.empty(len(keys), np.int64)
        out[order] = self.found[np.searchsorted(self.keys, keys[order])]
        return np.minimum(out, most)


def _asked_keys(tokens: np.ndarray, words: np.ndarray) -> np.ndarray:
    """All distinct keys that a model probes for these tokens."""
    keys = np.sort(np.concatenate([_word_keys(words), _word_keys(np.array([END])), _bigram_keys(_contexts(tokens), tokens)]))
    return keys[np.concatenate([[True], keys[1:] != keys[:-1]])]


def _planes(values: np.ndarray) -> bytes:
    return zstandard.compress(values.view(np.uint8).reshape(len(values), -1).T.tobytes(), 1)


def _from_planes(data: bytes, kind: str) -> np.ndarray:
    raw, width = np.frombuffer(zstandard.decompress(data), np.uint8), np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(kind).ravel()


def _chunks(frequent, scale: float):
    """One row per chunk: its `docs`, its distinct words, the most frequent first, and its tokens as places among them."""

    def chunk(at: int, held: list[tuple]) -> pa.RecordBatch:
        tokens, sizes = (np.concatenate([h[i] for h in held]) for i in (1, 2))
        rows = pa.Table.from_batches([h[0] for h in held]).combine_chunks()
        starts = np.cumsum(sizes) - sizes
        words, back, times = np.unique(tokens, return_inverse=True, return_counts=True)
        order = np.argsort(-times)
        rank = np.empty(len(order), "<u4")
        rank[order] = np.arange(len(order))
        counts = frequent.value(words)
        known = counts[back] > 0
        base = np.where(counts > 0, np.log10((counts + 0.5) / scale), 0.0)[back]
        bounds = np.concatenate([[0], np.cumsum(np.add.reduceat((~known).astype(np.int64), starts))])
        columns = {
            "doc_id": rows["doc_id"].combine_chunks(), "learned": rows["learned"].combine_chunks(), "n_tokens": pa.array(sizes, pa.int64()),
            "n_frequent": pa.array(np.add.reduceat(known.astype(np.int64), starts)), "base": pa.array(np.add.reduceat(base, starts)),
            "rare": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(tokens[~known].view(np.int64))),
        }
        docs = pa.StructArray.from_arrays(list(columns.values()), list(columns))
        return pa.RecordBatch.from_arrays(
            [pa.array([at], pa.int64()), pa.array([words[order].tobytes()], pa.binary()), pa.array([_planes(rank[back])], pa.binary()), pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs)],
            ["chunk", "words", "places", "docs"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, n = TaskContext.get().partitionId() << 32, [], 0
        for rows, tokens, sizes in _slices(batches):
            held.append((rows.select(["doc_id", "learned"]), tokens, sizes))
            n += len(tokens)
            if n >= _CHUNK:
                yield chunk(at, held)
                at, held, n = at + 1, [], 0
                release()
        if held:
            yield chunk(at, held)
        del held
        release()

    return run


def _tokens_of(words: bytes, places: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(words, np.uint64), _from_planes(places, "<u4")


def _asked(group_bits: int):
    """Rows (group, chunk, run): the keys that each group is asked for by a chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, words, places in zip(*(batch[c].to_pylist() for c in ("chunk", "words", "places"))):
                words, back = _tokens_of(words, places)
                keys = _asked_keys(words[back], words)
                own = (keys >> np.uint64(_KEY_BITS - group_bits)).astype(np.int64)
                first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                runs = [_planes(np.diff(part, prepend=np.uint64(0))) for part in np.split(keys, first[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(own[first]), pa.array([at] * len(runs), pa.int64()), pa.array(runs, pa.binary())], ["group", "chunk", "run"])
                release()

    return run


def _answer(block_bits: int):
    """One group: its blocks as a filter, and every chunk's keys answered with their levels."""

    def run(table_: pa.Table) -> pa.Table:
        blocks, chunks, data = (table_[c].to_pylist() for c in ("block", "chunk", "run"))
        own = Filter(block_bits, {b: d for b, d in zip(blocks, data) if b is not None})
        out = []
        for c, d in zip(chunks, data):
            if c is not None:
                keys = np.cumsum(_from_planes(d, "<u8"), dtype=np.uint64)
                out.append((c, zstandard.compress(own.levels(keys, np.full(len(keys), _LEVELS)).astype(np.uint8).tobytes(), 1)))
        group = table_["group"][0].as_py()
        return pa.table([pa.array([c for c, _ in out], pa.int64()), pa.array([group] * len(out), pa.int64()), pa.array([d for _, d in out], pa.binary())], ["chunk", "group", "run"])

    return run


def _score_chunk(n: int, v: int, ratio: np.ndarray, least: int):
    """One chunk: its tokens, the answers of all groups, and the scores of its documents."""

    def run(table_: pa.Table) -> pa.Table:
        groups = table_["group"].to_numpy()
        own = int(np.flatnonzero(groups == -1)[0])
        docs = pa.concat_arrays([x.values.slice(x.offsets[0].as_py(), x.offsets[-1].as_py() - x.offsets[0].as_py()) for x in table_["docs"].slice(own, 1).chunks])
        sizes = docs.field("n_tokens").to_numpy()
        if v:
            words, back = _tokens_of(table_["words"][own].as_py(), table_["places"][own].as_py())
            answers = [np.frombuffer(zstandard.decompress(table_["run"][int(i)].as_py()), np.uint8) for i in np.argsort(groups) if i != own]
            model = Model(Answers(_asked_keys(words[back], words), np.concatenate(answers).astype(np.int64)), ratio, least, n, v)
            scores = np.add.reduceat(model.of_places(words, back), np.cumsum(sizes) - sizes)
        else:
            scores = np.zeros(len(sizes))
        names = ["doc_id", "learned", "n_tokens", "n_frequent", "base", "rare"]
        return pa.table([*[docs.field(c) for c in names], pa.array(scores)], [*names, "score"])

    return run


def score(docs: DataFrame, learn: Column, max_bytes: int = MAX_BYTES, max_words: int = MAX_WORDS) -> DataFrame:
    """Per row: doc_id, learned, n_tokens, n_known, train_tokens, base_score, score.

    Rows for which `learn` holds (a null counts as not) teach the counts; all are scored. Null and
    empty texts are their end token. Repeated rows count and are answered each on its own. Without
    anything to learn from, base_score is that of N = V = 0 and score that of a uniform distribution
    over one unknown word (0). Other columns are not looked at.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id"), whole_text().alias("text"), F.coalesce(learn, F.lit(False)).alias("learned"))
    counted = count(texts.where("learned").select("text"), max_words)
    n, v = counted.n, counted.v
    scale = n + 0.5 * (v + 1)
    group_bits = min(counted.block_bits, max(6, math.ceil(math.log2(max(1, n / _PER_GROUP, counted.size / max_bytes)))))

    doc_type = texts.schema["doc_id"].dataType.simpleString()
    doc = f"doc_id:{doc_type},learned:boolean,n_tokens:bigint,n_frequent:bigint,base:double,rare:array<bigint>"
    cut = _chunks(spark.sparkContext.broadcast(counted.frequent), scale)
    # Stored, so that the chunks are fixed and the texts are read once.
    chunks = stored(texts.mapInArrow(cut, f"chunk long, words binary, places binary, docs array<struct<{doc}>>"))
    blocks = counted.blocks.select(F.shiftright("block", counted.block_bits - group_bits).alias("group"), "block", F.col("bits").alias("run"))
    asked = chunks.select("chunk", "words", "places").mapInArrow(_asked(group_bits), "group long, chunk long, run binary")
    asked = asked.unionByName(blocks, allowMissingColumns=True)
    answers = asked.groupBy("group").applyInArrow(_answer(counted.block_bits), "chunk long, group long, run binary")
    met = chunks.withColumn("group", F.lit(-1).cast("long")).unionByName(answers, allowMissingColumns=True)
    scored = met.groupBy("chunk").applyInArrow(_score_chunk(n, v, counted.ratio, counted.frequent.least), f"struct<{doc},score:double>")
    scored = stored(scored.withColumn("row", F.monotonically_increasing_id()))
    rare = scored.select("row", F.explode("rare").alias("word")).join(counted.words, "word", "left")
    c = F.coalesce("c", F.lit(0))
    rare = rare.groupBy("row").agg(F.count("c").alias("n_rare"), F.sum(F.log10((c + 0.5) / F.lit(scale))).alias("more"))
    zero = F.lit(0)
    return scored.join(rare.withColumnRenamed("row", "rare_row"), F.col("row") == F.col("rare_row"), "left").select(
        "doc_id", "learned", "n_tokens", (F.col("n_frequent") + F.coalesce("n_rare", zero)).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("more", zero)).alias("base_score"), "score",
    )


@query()
def op1_lm_scoring(spark, sf_dir):
    """Every document's score under a model of four folds in five."""
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5))
    scored = score(table(spark, sf_dir, "documents"), F.coalesce(fold != 1, F.lit(True)))
    return scored.select("doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")

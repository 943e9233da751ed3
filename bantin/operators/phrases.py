"""Phrases counted by chunks of documents: helpers of `keywords` that work on whole columns of words."""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORD_END = "\n"  # between the words of a text; no word holds it
BATCH_PHRASES = 200_000  # phrases handed to the JVM at once
_PLACES = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5]


class Phrases(NamedTuple):
    """The distinct phrases of some documents, by document and then in order of their text."""

    ends: np.ndarray  # of each document, one more than documents
    words: pa.Array  # the distinct words in order
    places: list[np.ndarray]  # per place in the phrase: the word's number + 1, or 0
    tf: np.ndarray


def phrases_of(texts: pa.Array, lengths: Sequence[int], stop_words: Sequence[str]) -> Phrases:
    """All phrases of documents given as words joined by WORD_END; empty or null: no words.

    A phrase's text joins its words by a space, which sorts before any letter or digit: so phrases in
    order of their words' numbers are in order of their texts.
    """
    filled = pc.fill_null(texts, "")
    lists = pc.split_pattern(filled, WORD_END)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.flatten()
    offsets = offsets - offsets[0]
    encoded = flat.dictionary_encode()
    order = pc.sort_indices(encoded.dictionary)
    words = encoded.dictionary.take(order)
    number = np.empty(len(order), np.int64)
    number[order.to_numpy()] = np.arange(len(order))
    codes = number[encoded.indices.to_numpy()] if len(flat) else np.empty(0, np.int64)
    plain = ~pc.is_in(words, value_set=pa.array(list(stop_words) + [""], pa.string())).to_numpy(zero_copy_only=False)
    good = plain[codes]
    doc = np.repeat(np.arange(len(texts)), np.diff(offsets))
    most = max(lengths)
    if most > 4:
        raise ValueError("phrases of more than 4 words")
    docs, firsts, seconds = [], [], []
    for n in lengths:
        size = max(len(codes) - n + 1, 0)
        starts = np.flatnonzero(good[:size] & good[n - 1 : n - 1 + size] & (doc[:size] == doc[n - 1 : n - 1 + size]))
        at = [codes[starts + j] + 1 if j < n else np.zeros(len(starts), np.int64) for j in range(4)]
        docs.append(doc[starts])
        firsts.append((at[0] << 32) | at[1])
        seconds.append((at[2] << 32) | at[3])
    of, first, second = np.concatenate(docs), np.concatenate(firsts), np.concatenate(seconds)
    by_doc = np.argsort(of, kind="stable")
    of, first, second = of[by_doc], first[by_doc], second[by_doc]
    bounds = np.searchsorted(of, np.arange(len(texts) + 1))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):  # one short sort a document
        if b - a > 1:
            own = np.lexsort((second[a:b], first[a:b]))
            first[a:b], second[a:b] = first[a:b][own], second[a:b][own]
    new = np.ones(len(of), bool)
    new[1:] = (of[1:] != of[:-1]) | (first[1:] != first[:-1]) | (second[1:] != second[:-1])
    at = np.flatnonzero(new)
    tf = np.diff(np.append(at, len(of)))
    low = (1 << 32) - 1
    first, second = first[at], second[at]
    places = [first >> 32, first & low, second >> 32, second & low][:most]
    return Phrases(np.searchsorted(of[at], np.arange(len(texts) + 1)), words, places, tf)


def texts_of(found: Phrases, chosen=slice(None)) -> pa.Array:
    """The phrases as text."""
    parts = []
    for place in found.places:
        numbers = place[chosen]
        parts.append(found.words.take(pa.array(numbers - 1, mask=numbers == 0)))
    if not len(parts[0]):
        return pa.array([], pa.string())
    return pc.binary_join_element_wise(*parts, " ", null_handling="skip")


def keys_of(found: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """96 bits of a hash for each phrase, the same in every chunk: 64 and 32."""
    digests = b"".join(hashlib.blake2b(w.encode(), digest_size=16).digest() for w in found.words.to_pylist())
    hashes = np.frombuffer(digests, np.uint64).reshape(-1, 2)
    # Number 0, no word, adds nothing.
    hashes = np.concatenate([np.zeros((1, 2), np.uint64), hashes])
    one, two = np.zeros(len(found.tf), np.uint64), np.zeros(len(found.tf), np.uint64)
    for place, odd in zip(found.places, _PLACES):
        one += hashes[place, 0] * np.uint64(odd)
        two += hashes[place, 1] * np.uint64(odd)
    return one, (two >> np.uint64(32)).astype(np.uint32)


def distinct_keys(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The order that sorts the keys, and in it the group of each, the first of each group and its size."""
    order = np.argsort(one, kind="stable")
    a, b = one[order], two[order]
    if np.any((a[1:] == a[:-1]) & (b[1:] != b[:-1])):
        order = np.lexsort((two, one))
        a, b = one[order], two[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    starts = np.flatnonzero(new)
    return order, np.cumsum(new) - 1, starts, np.diff(np.append(starts, len(order)))


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending keys as their steps, first bytes first: the high bytes are nearly all 0 and cost little once compressed."""
    return np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack_sorted(packed: bytes) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(packed, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()
    return np.cumsum(steps, dtype=np.uint64)


def keys_by_shard(one: np.ndarray, two: np.ndarray, bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(shard, 64 bits, 32 bits, count) of the distinct keys; a shard is a range of keys."""
    order, _, starts, sizes = distinct_keys(one, two)
    firsts = order[starts]
    a, b = one[firsts], two[firsts]
    shard = (a >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(a), np.int64)
    cuts = np.flatnonzero(np.diff(shard)) + 1
    for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(a)]):
        if hi > lo:
            yield int(shard[lo]), a[lo:hi], b[lo:hi], sizes[lo:hi].astype(np.int32)


def count_shard(chunks: Sequence[tuple[bytes, bytes, bytes]]) -> list[bytes]:
    """For each chunk's packed keys the number of documents of all chunks that have them, as int32.

    A number is negative where the chunk is the first that has the key.
    """
    one = np.concatenate([unpack_sorted(c[0]) for c in chunks])
    two = np.concatenate([np.frombuffer(c[1], np.uint32) for c in chunks])
    counts = np.concatenate([np.frombuffer(c[2], np.int32) for c in chunks])
    order, group, starts, _ = distinct_keys(one, two)
    total = np.add.reduceat(counts[order].astype(np.int64), starts)
    df = np.empty(len(order), np.int32)
    df[order] = total[group]
    df[order[starts]] *= -1
    ends = np.cumsum([0] + [len(c[2]) // 4 for c in chunks])
    return [df[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]


def df_of(one: np.ndarray, two: np.ndarray, answers: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The document count of each key, and the keys this chunk is the first to have; answers go by shard."""
    if not len(one):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    signed = np.frombuffer(b"".join(answers), np.int32).astype(np.int64)
    order, group, starts, _ = distinct_keys(one, two)
    if len(signed) != len(starts):
        raise ValueError("the answers do not belong to this chunk")
    df = np.empty(len(order), np.int64)
    df[order] = np.abs(signed)[group]
    return df, order[starts][signed < 0]


def slices(ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of documents of about BATCH_PHRASES phrases."""
    a = 0
    while a < len(ends) - 1:
        b = max(a + 1, int(np.searchsorted(ends, ends[a] + BATCH_PHRASES, side="right")) - 1)
        yield a, b
        a = b

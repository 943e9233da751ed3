"""Token ids of whole texts from a tokenizer file, with the ids of words remembered in each worker."""

from __future__ import annotations

import functools
import gc
import json
import os
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from bantin.llm.common import cached, claim

# Words remembered in a worker: so many recent ones, and as many from before. Only speed depends on it.
_KEPT_WORDS = 300_000
# Texts are split into words this many bytes at a time.
_SLICE_BYTES = 4 << 20
_TAIL = b".,;:!?"
# The steps of a tokenizer that keeps letters together.
_REPLACE = {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
_PIECES = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
# Letters of Latin-1 and Latin Extended-A that no normal form changes and that have one small letter each.
_LETTERS = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0148\u014a-\u017e]+").fullmatch
# How byte-level models write bytes that are no printable character.
_BYTES = {b: 256 + 33 + b - 127 for b in range(127, 161)} | {173: 256 + 67}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """Ids of texts under a tokenizer that drops white space and never joins across it.

    So a text's ids are those of its space-separated pieces one after another, and each distinct
    piece goes to the tokenizer once. Letters followed by punctuation are two words to such a
    tokenizer, and are looked up apart. Tests compare with the tokenizer on whole texts.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        # Of a word of plain letters, such steps before the model leave its lower-cased bytes as one piece.
        steps = json.loads(self.tokenizer.to_str())
        plain = [x.get("type") for x in ((steps["normalizer"] or {}).get("normalizers") or [])] == ["NFC", "Replace", "Lowercase"]
        self.direct = self.tokenizer.model.tokenize if plain and steps["normalizer"]["normalizers"][1] == _REPLACE and steps["pre_tokenizer"] == _PIECES else None
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def encode(self, texts: Iterable[bytes], end_id: int | None = None) -> Iterator[np.ndarray]:
        """The ids of each text, without special tokens, as `dtype`; `end_id` after each, if given."""
        # Nothing here makes cycles, and looking for them in tables this large takes a tenth of the time.
        gc.disable()
        try:
            yield from self._sliced(texts, b"" if end_id is None else np.array([end_id], self.dtype).tobytes())
        finally:
            gc.enable()

    def _sliced(self, texts: Iterable[bytes], end: bytes) -> Iterator[np.ndarray]:
        held, size = [], 0
        for text in texts:
            held.append(text)
            size += len(text)
            if size >= _SLICE_BYTES:
                yield from self._encode(held, end)
                held, size = [], 0
        yield from self._encode(held, end)

    def _encode(self, texts: list[bytes], end: bytes) -> Iterator[np.ndarray]:
        # Pieces are split, told apart and replaced in Arrow; only the distinct ones become Python objects.
        pieces = pc.ascii_split_whitespace(pa.array(texts, pa.string()))
        coded = pieces.values.dictionary_encode()
        distinct = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        ids = pa.array(self._ids_of(distinct), pa.large_binary()).take(coded.indices)
        _, offsets, data = ids.buffers()
        bounds = np.frombuffer(offsets, np.int64, len(ids) + 1)[pieces.offsets.to_numpy()].tolist() if len(ids) else [0] * (len(texts) + 1)
        flat = memoryview(data or b"")
        for start, stop in zip(bounds, bounds[1:]):
            yield np.frombuffer(b"".join((flat[start:stop], end)), self.dtype)

    def _ids_of(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of distinct pieces, in their order."""
        if len(self.known) > _KEPT_WORDS:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        out = list(map(known.get, pieces))
        new = []
        for i in [i for i, x in enumerate(out) if x is None]:
            x = older.get(pieces[i])
            if x is None:
                new.append(i)
            else:
                out[i] = known[pieces[i]] = x
        parts = [_parts(pieces[i]) for i in new]
        code, left, texts = "HI"[self.dtype.itemsize // 4], [], []
        for word in {w for x in parts for w in x}.difference(known):
            text = word.decode()
            if self.direct and _LETTERS(text):
                known[word] = array(code, [t.id for t in self.direct(_byte_level(text.lower()))]).tobytes()
            else:
                left.append(word)
                texts.append(text)
        for word, x in zip(left, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            known[word] = array(code, x.ids).tobytes()
        for i, x in zip(new, parts):
            out[i] = known[pieces[i]] = known[x[0]] if len(x) == 1 else known[x[0]] + known[x[1]]
        return out


def _byte_level(text: str) -> str:
    return text if text.isascii() else text.encode().decode("latin-1").translate(_BYTES)


def _parts(piece: bytes) -> tuple[bytes, ...]:
    """Letters and the punctuation after them; any other piece as it is."""
    word = piece.rstrip(_TAIL)
    if word.isalpha():
        # The tokenizer lower-cases; for ASCII that is the same everywhere.
        return (word.lower(), piece[len(word) :]) if len(word) < len(piece) else (word.lower(),)
    if not word or len(word) == len(piece) or not word.decode().isalpha():
        return (piece,)
    return word, piece[len(word) :]


@functools.lru_cache(maxsize=2)
def _kept(path: str) -> Encoder:
    return Encoder(path)


cached("tokens", _kept.cache_clear)


def encoder(path: str) -> Encoder:
    """The worker's own encoder."""
    claim("tokens")
    return _kept(path)

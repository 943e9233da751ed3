"""Token files: every document's ids compressed alone, under one shared zstandard dictionary.

A file is: the magic bytes, the compressed documents one after another, an index (Arrow stream:
doc_id, offset, size, n_tokens), then a tail of fixed size: the index's offset and size, the bytes
of an id and the SHA-256 of the dictionary. So one document costs one read of the tail, one of the
index and one of its own bytes. Files hold documents in ascending doc_id order, and a Parquet
manifest lists the files of the finished write; what a failed or doubled task left is not listed.

Files go through pyarrow's file systems, as local paths, file://, hdfs:// or object stores.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bantin.llm.common import as_bytes, query, shared_folder, table, whole_text
from bantin.llm.tokenise import default_tokenizer, encoder

END_ID = 2
MAGIC = b"IDFILE01"
_TAIL = struct.Struct("<QQB32s")
# Compressed bytes after which a task begins a new file.
FILE_BYTES = 64 << 20
DICTIONARY_BYTES = 64 << 10
# The dictionary is trained on at most this many documents of at most this many characters.
SAMPLE_DOCS = 1_000
SAMPLE_CHARS = 8_192
_INDEX = pa.schema([("doc_id", pa.int64()), ("offset", pa.int64()), ("size", pa.int64()), ("n_tokens", pa.int64())])
_MANIFEST = "part int, number int, file string, n_docs long, n_tokens long"


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def train_dictionary(docs: DataFrame, tokenizer: str, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> bytes:
    """A dictionary from the ids of a bounded sample: short documents with the smallest hashes of doc_id and text.

    With too little to train on, the sample's ids themselves are the dictionary; it may be empty.
    """
    # As large a part of all hashes as makes about `sample_docs`, so that a task sends only its share.
    highest = -(2**63) + min(1.0, sample_docs / max(1, docs.count())) * 2.0**64
    low = docs.select(whole_text().alias("text"), F.xxhash64("doc_id", "text").alias("h")).where(F.col("h") <= F.lit(highest))
    rows = low.where(F.length("text") <= sample_chars).limit(2 * sample_docs).collect()
    texts = [r.text.encode() for r in sorted(rows, key=lambda r: (r.h, r.text))]
    samples = [x.tobytes() for x in encoder(tokenizer).encode(texts)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


class _Writer:
    """One file being written."""

    def __init__(self, folder: str, name: str) -> None:
        system, root = _open(folder)
        self.name, self.at, self.tokens, self.rows = name, len(MAGIC), 0, []
        self.out = system.open_output_stream(f"{root}/{name}")
        self.out.write(MAGIC)

    def add(self, doc: int | None, data: bytes, n: int) -> None:
        self.out.write(data)
        self.rows.append((doc, self.at, len(data), n))
        self.at, self.tokens = self.at + len(data), self.tokens + n

    def close(self, width: int, digest: bytes) -> tuple:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, _INDEX) as stream:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*self.rows), _INDEX)]
            stream.write_batch(pa.RecordBatch.from_arrays(columns, schema=_INDEX))
        index = sink.getvalue()
        self.out.write(index)
        self.out.write(_TAIL.pack(self.at, index.size, width, digest))
        self.out.close()
        return self.name, len(self.rows), self.tokens


def write_token_files(
    docs: DataFrame, folder: str, end_id: int = END_ID, tokenizer: str | None = None, file_bytes: int = FILE_BYTES, level: int = 3
) -> None:
    """Write the ids of every document, each with `end_id` after it, in ascending doc_id order.

    A null text is empty: the end id alone. Repeated rows are written each; null doc_ids come first.
    An empty table gives a folder with a dictionary and no files.
    """
    spark, path = docs.sparkSession, tokenizer or default_tokenizer()
    data = train_dictionary(docs, path)
    system, root = _open(folder)
    system.create_dir(f"{root}/ids", recursive=True)
    with system.open_output_stream(f"{root}/dictionary") as out:
        out.write(data)
    digest, shared = hashlib.sha256(data).digest(), spark.sparkContext.broadcast(data)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        press = zstandard.ZstdCompressor(level=level, dict_data=_dictionary(shared.value), write_content_size=True)
        part, attempt, done, file = TaskContext.get().partitionId(), uuid.uuid4().hex, [], None
        for batch in batches:
            for doc, ids in zip(batch["doc_id"].to_pylist(), encode.encode(as_bytes(batch["text"]), end_id)):
                file = file or _Writer(f"{folder}/ids", f"part-{part:06d}-{len(done):04d}-{attempt}.ids")
                file.add(doc, press.compress(ids.tobytes()), len(ids))
                if file.at >= file_bytes:
                    done.append(file.close(encode.dtype.itemsize, digest))
                    file = None
        if file:
            done.append(file.close(encode.dtype.itemsize, digest))
        if done:
            names, n_docs, n_tokens = zip(*done)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(done), pa.int32()), pa.array(range(len(done)), pa.int32()), pa.array(names),
                 pa.array(n_docs, pa.int64()), pa.array(n_tokens, pa.int64())],
                ["part", "number", "file", "n_docs", "n_tokens"],
            )

    texts = docs.select(F.col("doc_id").cast("long"), whole_text().alias("text"))
    # The text's hash lets the ranges part rows that share a doc_id, or have none.
    order = [F.col("doc_id"), F.xxhash64("text")]
    in_order = texts.repartitionByRange(*order).sortWithinPartitions(*order)
    in_order.mapInArrow(write, _MANIFEST).write.parquet(f"{folder}/manifest")


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """The listed files, each with the number of ids in all files before it."""
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    files = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")
    files = files.select("file", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))
    # A row is a whole file: as many tasks as files, and not as few as the size of these rows would make.
    return files.repartition(max(1, files.count()), "file")


class TokenFile:
    """Reads one file: the index at once, documents when asked for."""

    def __init__(self, folder: str, name: str, dictionary: bytes) -> None:
        system, root = _open(folder)
        self.file = system.open_input_file(f"{root}/ids/{name}")
        at, size, width, digest = _TAIL.unpack(self.file.read_at(_TAIL.size, self.file.size() - _TAIL.size))
        if digest != hashlib.sha256(dictionary).digest():
            raise ValueError(f"{name} was written with another dictionary")
        self.dtype = np.dtype(f"<u{width}")
        self.index = pa.ipc.open_stream(pa.py_buffer(self.file.read_at(size, at))).read_all()
        self.unpress = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))

    def ids(self, offset: int, size: int) -> np.ndarray:
        return np.frombuffer(self.unpress.decompress(self.file.read_at(size, offset)), self.dtype).astype("<u4")


def _dictionary_of(folder: str) -> bytes:
    system, root = _open(folder)
    with system.open_input_stream(f"{root}/dictionary") as file:
        return file.read()


def read_token_files(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """Every document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, and `ids`."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dictionary = _dictionary_of(folder)
        for batch in batches:
            for name, base in zip(batch["file"].to_pylist(), batch["base"].to_pylist()):
                file = TokenFile(folder, name, dictionary)
                for part in file.index.to_batches(max_chunksize=1_000):
                    for rows in (part.slice(i, 200) for i in range(0, len(part), 200)):
                        ids = [file.ids(*x) for x in zip(rows["offset"].to_pylist(), rows["size"].to_pylist())]
                        n = [len(x) for x in ids]
                        starts = base + np.cumsum([0, *n])
                        base = int(starts[-1])
                        yield pa.RecordBatch.from_arrays(
                            [rows["doc_id"], pa.array(starts[:-1], pa.int64()), pa.array(n, pa.int64()),
                             pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64()),
                             pa.array([x if with_ids else None for x in ids], pa.list_(pa.int64()))],
                            ["doc_id", "start", "n_tokens", "ids_crc32", "ids"],
                        )

    files = _files(spark, folder)
    out = files.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long, ids array<long>")
    return out if with_ids else out.drop("ids")


def lookup(spark: SparkSession, folder: str, wanted: DataFrame) -> DataFrame:
    """doc_id and ids of the documents whose doc_id is in `wanted`, by index and single reads."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dictionary = _dictionary_of(folder)
        for batch in batches:
            for name in batch["file"].to_pylist():
                for rows in TokenFile(folder, name, dictionary).index.to_batches():
                    yield pa.RecordBatch.from_arrays([rows["doc_id"], rows["offset"], rows["size"], pa.array([name] * len(rows))], ["doc_id", "offset", "size", "file"])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dictionary, name, file = _dictionary_of(folder), None, None
        for batch in batches:
            ids = []
            for own, offset, size in zip(*(batch[c].to_pylist() for c in ("file", "offset", "size"))):
                if own != name:
                    name, file = own, TokenFile(folder, own, dictionary)
                ids.append(file.ids(offset, size))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(ids, pa.list_(pa.int64()))], ["doc_id", "ids"])

    places = _files(spark, folder).mapInArrow(index, "doc_id long, offset long, size long, file string")
    asked = places.join(wanted.select(F.col("doc_id").cast("long")).distinct(), "doc_id")
    return asked.sortWithinPartitions("file", "offset").mapInArrow(fetch, "doc_id long, ids array<long>")


@query()
def op9_token_files(spark, sf_dir):
    """All documents written to token files and read back."""
    folder = shared_folder(spark)
    write_token_files(table(spark, sf_dir, "documents"), folder)
    return read_token_files(spark, folder, with_ids=False)

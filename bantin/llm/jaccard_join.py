"""N-gram Jaccard join: groups of documents linked by the similarity of their word shingles.

Two sets with Jaccard similarity of t or more differ in few elements, so when the hash space is cut
into more segments than that, one segment is equal in both. Sets are banded by size: the sizes of a
pair lie in one band or in neighbouring ones, and a set takes part in the tiles of its own band and
of the next. A tile is (band, segment, the segment's content): sets that meet in none are not
similar, whatever their words, and a common passage makes no hot tile, as its segments also hold the
rest of each text. A first pass over the texts fills filters of tiles seen once and twice, of fixed size;
most tiles are met once and are not sent. What is sent is shuffled by tile once, in 16 bytes a tile and
class; tiles with the same members then go on as one.

Documents with equal sets are one class. Within a tile, each class is paired with the one that
shares most tiles with others, of near copies their origin; pairs pass a bound from hashed bitmaps
(the bits in which two parity bitmaps differ are at most the elements in which the sets do) and then
the exact intersection of sorted arrays. Only classes of pairs that pass the bound have their arrays
made, by a pass that knows their texts by a hash. Groups these links do not join, but that share a tile, are
compared by their bitmaps in blocks of at most BLOCK classes. Of what passes, the closest pairs of a
class and another group are intersected first; what links leave apart then has its next closest, and
at last all its other pairs. So no link between different groups is lost, and a large group of near
copies costs links to one of them, not all its pairs.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bantin.llm.common import WORD_HASHES, as_bytes, claim, discard, mixed, query, release, small_parts, stored, table, whole_text, window_hashes
from bantin.llm.components import connected_components
from bantin.llm.seen_twice import Pair, SeenTwice, merged_pairs, seen_twice

WORDS, PERCENT = 3, 90
BLOCK = 512
# Tiles are many: their filters have 32 MB each.
TILE_BITS = 28
_MAX_BITS = 16_384
# Pairs of a class and another group, in order of their bitmaps' difference, that are tried in a round.
_ROUNDS = [(0, 1), (1, 16), (16, None)]


def shingles(text: bytes, n: int) -> np.ndarray:
    """Sorted hashes of the distinct runs of n words; of fewer words, the whole run; empty without words."""
    words = text.lower().split()
    return np.unique(window_hashes(WORD_HASHES.of(words), min(n, len(words)))) if words else np.empty(0, np.uint64)


def _content(hashes: np.ndarray) -> int:
    return int(mixed(np.array([mixed(hashes ^ np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64) + np.uint64(len(hashes))], np.uint64)).view(np.int64)[0])


class Bands:
    """Size bands and the number of segments in each, for a similarity of `percent`."""

    def __init__(self, percent: int) -> None:
        self.percent, self.low = percent, [1]

    def of(self, size: int) -> int:
        while self.low[-1] <= size:
            self.low.append(self.low[-1] * 100 // self.percent + 1)
        return int(np.searchsorted(self.low, size, "right")) - 1

    @functools.cache
    def segments(self, band: int) -> tuple[int, int]:
        """Number of segments, and how many of them may be empty before empty ones count.

        Sets of the band differ in at most `differ` elements, so of `differ + 1 + spare` segments at
        least `1 + spare` are equal in both. With at most `spare` empty ones, one equal segment is not
        empty; only a set with more empty segments must also be found by these.
        """
        self.of(self.low[-1] if len(self.low) > band + 1 else 10**9)
        low, high = self.low[band], self.low[band + 1] - 1
        differ = (100 - self.percent) * 2 * high // (100 + self.percent)
        spare = 1 + math.ceil(2 * (differ + 1) * math.exp(-low / (differ + 1))) if differ else 0
        return differ + 1 + spare, spare

    def tiles(self, hashes: np.ndarray) -> np.ndarray:
        """The tiles of one set."""
        out, band = [], self.of(len(hashes))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(hashes), dtype=np.uint64)])
        for b in (band, band + 1):
            k, spare = self.segments(b)
            segment = ((hashes >> np.uint64(32)) * np.uint64(k)) >> np.uint64(32)
            bounds = np.searchsorted(segment, np.arange(k + 1, dtype=np.uint64))
            content, empty = sums[bounds[1:]] - sums[bounds[:-1]], bounds[1:] == bounds[:-1]
            names = np.arange(k, dtype=np.uint64) + np.uint64(b << 32)
            tile = mixed(content + mixed(names * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)))
            out.append(tile if empty.sum() > spare else tile[~empty])
        return np.concatenate(out)


def bitmap(hashes: np.ndarray) -> bytes:
    """Parity of the hashes that fall on each bit; there are two to four bits for each hash."""
    bits = min(_MAX_BITS, 1 << max(7, (2 * len(hashes) - 1).bit_length()))
    odd = np.bincount((mixed(hashes ^ np.uint64(7)) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _folded(bitmaps: list[bytes]) -> np.ndarray:
    """Bitmaps of one width: halves of a wider one are combined, which keeps it a parity bitmap."""
    width = min(map(len, bitmaps)) // 8
    return np.stack([np.bitwise_xor.reduce(np.frombuffer(b, np.uint64).reshape(-1, width), axis=0) for b in bitmaps])


def _may_link(n_a: np.ndarray, n_b: np.ndarray, differing: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of these sizes, that differ in at least so many elements, can be similar enough."""
    both = n_a + n_b
    return (100 + percent) * (both - differing) >= 2 * percent * both


def _all_sets(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """doc_id, n_shingles and `same`, a hash that stands for the set (null: empty set).

    Rows with a `block` are the tasks' filters of tiles seen once and twice, each class once a task.
    """
    empty = {"doc_id": pa.int64(), "n_shingles": pa.int64(), "same": pa.int64(), "block": pa.int32(), "once": pa.binary(), "twice": pa.binary()}

    def full(columns: dict[str, pa.Array], rows: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns[k] if k in columns else pa.nulls(rows, t) for k, t in empty.items()], list(empty))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("words")
        bands, met, pair = Bands(percent), set(), Pair(TILE_BITS)
        for batch in small_parts(batches):
            sizes, names, tiles = [], [], [np.empty(0, np.uint64)]
            for text in as_bytes(batch["text"]):
                hashes = shingles(text, n)
                same = _content(hashes) if len(hashes) else None
                sizes.append(len(hashes))
                names.append(same)
                if same is not None and same not in met:
                    met.add(same)
                    tiles.append(bands.tiles(hashes))
            pair.add(np.concatenate(tiles))
            yield full({"doc_id": batch["doc_id"], "n_shingles": pa.array(sizes, pa.int64()), "same": pa.array(names, pa.int64())}, len(batch))
        for rows in pair.blocks():
            yield full(dict(zip(rows.schema.names, rows.columns)), len(rows))
        del pair
        release()

    return docs.mapInArrow(run, "doc_id long, n_shingles long, same long, block int, once binary, twice binary")


def _keys(texts: list[bytes]) -> np.ndarray:
    """Hashes that tell texts apart."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, texts), np.uint64, len(texts))


def _class_rows(docs: DataFrame, n: int, percent: int, known: SeenTwice) -> DataFrame:
    """Classes with tiles that the filter may have seen twice, once per class and task; stored.

    same, n, bits (bitmap), key (of one of its texts) and these tiles.
    """
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, met = Bands(percent), set()
        for batch in small_parts(batches):
            rows, texts, tiles = [], [], []
            for text in as_bytes(batch["text"]):
                hashes = shingles(text, n)
                same = _content(hashes) if len(hashes) else None
                if same is not None and same not in met:
                    met.add(same)
                    own = bands.tiles(hashes)
                    own = own[shared.value.has(own)]
                    if len(own):
                        rows.append((same, len(hashes), bitmap(hashes)))
                        texts.append(text)
                        tiles.append(own)
            if rows:
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary()))]
                ends = pa.array(np.cumsum([0, *map(len, tiles)]), pa.int32())
                lists = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(tiles).view(np.int64)))
                yield pa.RecordBatch.from_arrays([*columns, pa.array(_keys(texts).view(np.int64)), lists], ["same", "n", "bits", "key", "tiles"])
        release()

    out = stored(docs.select("text").mapInArrow(run, "same long, n long, bits binary, key long, tiles array<long>"))
    shared.destroy()
    return out


def _shared_tiles(rows: DataFrame) -> DataFrame:
    """tile, same and how many tiles they stand for, of tiles with several classes; stored.

    Near copies share many tiles: those with the same members are one, named by a hash of the members.
    Members whose hashes collide would be one larger tile, which only has more pairs to compare.
    """
    by_tile = Window.partitionBy("tile")
    # Dealt by tile once: distinct, count and hash of the members need no other shuffle.
    dealt = rows.select(F.explode("tiles").alias("tile"), "same").repartition("tile").distinct()
    met = dealt.select("same", F.count("*").over(by_tile).alias("m"), F.bit_xor(F.xxhash64("same")).over(by_tile).alias("members")).where("m > 1")
    return stored(met.groupBy(F.col("members").alias("tile"), "same").agg(F.count("*").alias("n_shared")))


def _hashes_of(docs: DataFrame, classes: DataFrame, n: int) -> DataFrame:
    """same and hashes (sorted, 64-bit) of the given classes (same, key), once each, stored."""
    known = seen_twice(classes.select("key"), lambda b: np.repeat(mixed(b["key"].to_numpy().view(np.uint64)), 2))
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for batch in small_parts(batches):
            texts = as_bytes(batch["text"])
            sets = [shingles(texts[i], n) for i in np.flatnonzero(shared.value.has(mixed(_keys(texts))))]
            rows = []
            for hashes in sets:
                same = _content(hashes) if len(hashes) else None
                if same is not None and same not in met:
                    met.add(same)
                    rows.append((same, hashes.tobytes()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.binary()))], ["same", "hashes"])
        release()

    found = docs.select("text").mapInArrow(run, "same long, hashes binary")
    out = stored(found.dropDuplicates(["same"]).join(classes, "same", "left_semi"))
    shared.destroy()
    return out


def _links(pairs: DataFrame, sets: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) that are similar: bitmaps first, then the sets of what they leave; stored."""
    side = lambda frame, name, *columns: frame.select(F.col("same").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in columns])

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("none")
        for batch in small_parts(batches, 1_000):
            differing = np.array(
                [int(np.bitwise_count(np.bitwise_xor(*_folded(pair))).sum()) for pair in zip(batch["bits_a"].to_pylist(), batch["bits_b"].to_pylist())], np.int64
            )
            keep = _may_link(batch["n_a"].to_numpy(), batch["n_b"].to_numpy(), differing, percent)
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], ["a", "b"]).filter(pa.array(keep, pa.bool_()))
        release()

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("none")
        for batch in small_parts(batches):
            keep = []
            for x, y in zip(batch["hashes_a"].to_pylist(), batch["hashes_b"].to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.sort(np.concatenate([x, y]), kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], ["a", "b"]).filter(pa.array(keep, pa.bool_()))
        release()

    # A pair is work for Python, so a task has a hundredth of the rows of other small tables. Few pairs still meet all bitmaps.
    light = pairs.join(side(sets, "a", "n", "bits"), "a").join(side(sets, "b", "n", "bits"), "b")
    left = stored(light.select("a", "b", "n_a", "bits_a", "n_b", "bits_b").mapInArrow(bound, "a long, b long"), max(100 * pairs.count(), sets.count()))
    n_left = left.count()
    if not n_left:
        return left
    ends = left.select(F.explode(F.array("a", "b")).alias("same")).distinct()
    classes = stored(sets.select("same", "key").join(ends, "same", "left_semi"), sets.count())
    hashes = _hashes_of(docs, classes, n)
    heavy = left.join(side(hashes, "a", "hashes"), "a").join(side(hashes, "b", "hashes"), "b")
    out = stored(heavy.select("a", "b", "hashes_a", "hashes_b").mapInArrow(exact, "a long, b long"), 100 * n_left)
    discard(left, classes, hashes)
    return out


def _unjoined_pairs(tiles: DataFrame, sets: DataFrame, roots: DataFrame, percent: int, closest: tuple[int, int | None]) -> DataFrame:
    """Pairs of classes that share a tile, are not joined yet, and that their bitmaps do not part; stored.

    For each class and other group only the pairs at these places in the order of difference. A place
    never moves forward when groups are joined, so all places in turn miss no pair.
    """
    n = tiles.count()
    rooted = tiles.select("tile", "same").join(roots.select(F.col("node").alias("same"), "root"), "same", "left")
    rooted = stored(rooted.withColumn("root", F.coalesce("root", "same")), n)
    groups = rooted.groupBy("tile", "root").agg(F.count("*").alias("m"))
    # A pair can only have a later place where a group has that many more classes in the tile.
    open_ = groups.groupBy("tile").agg(F.sum("m").alias("m"), F.count("*").alias("groups"), F.max("m").alias("largest")).where(f"groups > 1 AND largest > {closest[0]}")
    chosen = stored(open_.select("tile", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks")), n)
    open_ = rooted.join(chosen, "tile").select("tile", "same", "root", "blocks")
    own = F.pmod(F.xxhash64("same"), F.col("blocks")).cast("int")
    # Each block meets every block once: as the first of a pair of blocks, or as the second.
    meets = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least(o, F.col("own")).alias("i"), F.greatest(o, F.col("own")).alias("j")))
    dealt = open_.withColumn("own", own).select("tile", "same", "root", "own", F.explode(meets).alias("at"))
    dealt = dealt.select("tile", "at.i", "at.j", "own", "same", "root").join(sets.select("same", "n", "bits"), "same")
    grouped = dealt.repartition("tile", "i", "j").sortWithinPartitions("tile", "i", "j", "same")

    def compare(rows: list[tuple]) -> Iterator[tuple[int, int]]:
        if len({r[6] for r in rows}) < 2:
            return
        names, n, root = (np.array([r[k] for r in rows], np.int64) for k in (3, 4, 6))
        bits = _folded([r[5] for r in rows])
        for x in range(len(rows) - 1):
            y = slice(x + 1, None)
            differing = np.bitwise_count(bits[y] ^ bits[x]).sum(axis=1, dtype=np.int64)
            found = np.flatnonzero((root[y] != root[x]) & _may_link(n[y], n[x], differing, percent))
            if len(found):
                found = found[np.lexsort((names[y][found], differing[found], root[y][found]))]
                group = root[y][found]
                place = np.arange(len(found)) - np.searchsorted(group, group)
                chosen = found[(place >= closest[0]) & (place < (closest[1] or len(found)))]
                for other in names[y][chosen].tolist():
                    yield min(other, int(names[x])), max(other, int(names[x]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, met = None, [], set()

        def flush(found: Iterator[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
            new = list(dict.fromkeys(p for p in found if p not in met))
            if len(met) > 1_000_000:
                met.clear()
            met.update(new)
            if new:
                a, b = zip(*new)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            for row in zip(*(batch[c].to_pylist() for c in ("tile", "i", "j", "same", "n", "bits", "root"))):
                if row[:3] != key:
                    yield from flush(compare(rows))
                    key, rows = row[:3], []
                rows.append(row)
        yield from flush(compare(rows))

    out = stored(grouped.mapInArrow(run, "a long, b long").distinct(), 100 * n)
    discard(rooted, chosen)
    return out


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Two documents link when 100 * intersection >= percent * union of their shingle sets;
    component_id is the smallest doc_id that links reach, the document's own included. A document
    without words has an empty set, no links and its own doc_id. Rows are answered each on its own;
    a null doc_id takes part but is no component_id unless alone. Other columns are not looked at.
    Shingles and classes are told apart by 64-bit hashes.
    """
    texts = docs.select(F.col("doc_id").cast("long"), whole_text().alias("text"))
    first = stored(_all_sets(texts, words, percent))
    known = merged_pairs(first.where("block IS NOT NULL").select("block", "once", "twice"), TILE_BITS)
    all_sets = stored(first.where("block IS NULL").select("doc_id", "n_shingles", "same"))
    discard(first)
    rows = _class_rows(texts, words, percent, known)
    tiles = _shared_tiles(rows)
    n = tiles.count()
    shared = stored(tiles.groupBy("same").agg(F.sum("n_shared").alias("n_tiles")), n)
    sets = stored(rows.select("same", "n", "bits", "key").join(shared, "same", "left_semi").dropDuplicates(["same"]))
    discard(rows)
    counted = stored(tiles.select("tile", "same").join(shared, "same"), n)
    leaders = stored(counted.groupBy("tile").agg(F.max(F.struct("n_tiles", "same"))["same"].alias("leader")), n)
    stars = counted.join(leaders, "tile").where("same <> leader")
    stars = stored(stars.select(F.least("leader", "same").alias("a"), F.greatest("leader", "same").alias("b")).distinct(), n)
    discard(shared, counted, leaders)
    links = _links(stars, sets, texts, words, percent)
    roots = stored(connected_components(links), n)
    discard(stars, links)
    for closest in _ROUNDS:
        pairs = _unjoined_pairs(tiles, sets, roots, percent, closest)
        if pairs.isEmpty():
            break
        more = _links(pairs, sets, texts, words, percent)
        if not more.isEmpty():
            nodes = roots.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
            roots, old = stored(connected_components(nodes.unionByName(more)), n), roots
            discard(old)
        discard(pairs, more)
    discard(tiles, sets)

    classes = all_sets.where("same IS NOT NULL").groupBy("same").agg(F.min("doc_id").alias("first_id"))
    rooted = classes.join(roots.withColumnRenamed("node", "same"), "same", "left").withColumn("root", F.coalesce("root", "same"))
    rooted = stored(rooted)
    names = rooted.join(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "root").select("same", "component_id")
    named = all_sets.join(stored(names), "same", "left")
    return named.select("doc_id", "n_shingles", F.when(F.col("same").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def drop_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The documents with the smallest doc_id of their group, with all their columns.

    Rows of one doc_id are one document; it goes when each of them is in a group with a smaller one.
    """
    first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    found = near_duplicates(docs, words, percent).groupBy("doc_id").agg(F.max(first).alias("stays"))
    gone = stored(found.where("NOT stays").select(F.col("doc_id").alias("_gone")))
    return docs.join(gone, docs["doc_id"].cast("long").eqNullSafe(gone["_gone"]), "left_anti")


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"

SQL = f"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, {_WORDS} AS w FROM documents),
sh AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i : i + least({WORDS}, len(w)) - 1], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - least({WORDS}, len(w)) + 2)) AS i FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT d.doc_id, count(s) AS n FROM d LEFT JOIN sh ON sh.doc_id = d.doc_id GROUP BY d.doc_id),
links AS MATERIALIZED (SELECT a AS x, b AS y FROM (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS c FROM sh p JOIN sh q ON p.s = q.s AND p.doc_id <> q.doc_id GROUP BY ALL)
  JOIN n AS na ON na.doc_id = a JOIN n AS nb ON nb.doc_id = b WHERE 100 * c >= {PERCENT} * (na.n + nb.n - c)),
reach AS (SELECT doc_id, doc_id AS r FROM n UNION SELECT reach.doc_id, y FROM reach JOIN links ON r = x)
SELECT n.doc_id, n.n AS n_shingles, min(r) AS component_id FROM n JOIN reach ON reach.doc_id = n.doc_id GROUP BY ALL
"""


@query(SQL)
def op5_ngram_jaccard_join(spark, sf_dir):
    """Groups of documents with similar 3-word shingles."""
    return near_duplicates(table(spark, sf_dir, "documents"))

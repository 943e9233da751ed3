"""Approximate nearest neighbours by learned partitions.

On a bounded sample, the graph of nearest neighbours is cut into balanced parts with few edges
between them, and a small network learns to tell from a vector which parts its neighbours are in.
The network then deals every row to its most probable part and sends a query to several parts, as
many as the sample needs for the target recall; candidates there are ranked by their exact cosine.

A part is spread over blocks of bounded size, and so are a part's queries: a task sees one block of
each. So copies of one vector, which share a part, do not make a large task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bantin.llm.common import query, stored, table

# The graph and the network are fitted on about this many different vectors, at most twice as many.
SAMPLE = 4_096
# Sampled vectors per part; one part, and so an exhaustive search, below twice as many.
_PER_PART = 256
_NEIGHBOURS = 10
TARGET_RECALL = 0.97
_HIDDEN, _EPOCHS, _BATCH = 128, 40, 256
# Rows and queries of one block of an average part.
_BLOCK_ROWS, _BLOCK_QUERIES = 4_096, 1_024


# --- fitting --------------------------------------------------------------------------

def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest others of each unit vector, by blocks of rows."""
    out = np.empty((len(x), min(k, len(x) - 1)), np.int64)
    for a in range(0, len(x), 1_024):
        scores = x[a : a + 1_024] @ x.T
        scores[np.arange(len(scores)), np.arange(a, a + len(scores))] = -np.inf
        near = np.argpartition(-scores, out.shape[1] - 1, axis=1)[:, : out.shape[1]]
        out[a : a + 1_024] = near
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 12, slack: float = 1.1) -> np.ndarray:
    """A part for each vector, none larger than `slack` times the mean, with few edges cut.

    Begins with capacity-bound assignment to spread-out centres, then moves vectors, those that gain
    most first, to the part where most of their neighbours are and that still has room.
    """
    rng, n = np.random.default_rng(7), len(x)
    room = int(np.ceil(slack * n / parts))
    label = np.full(n, -1)
    centres = x[rng.choice(n, parts, replace=False)]
    for _ in range(8):
        scores, size = x @ centres.T, np.zeros(parts, int)
        label[:] = -1
        for i in np.argsort(-scores.max(axis=1)):
            for p in np.argsort(-scores[i]):
                if size[p] < room:
                    label[i], size[p] = p, size[p] + 1
                    break
        centres = np.stack([x[label == p].mean(axis=0) if (label == p).any() else centres[p] for p in range(parts)])
    source, target = np.repeat(np.arange(n), graph.shape[1]), graph.ravel()
    ends, others = np.concatenate([source, target]), np.concatenate([target, source])
    for _ in range(rounds):
        votes = np.zeros((n, parts))
        np.add.at(votes, (ends, label[others]), 1)
        gain = votes - votes[np.arange(n), label][:, None]
        size, moved = np.bincount(label, minlength=parts), 0
        for i in np.argsort(-gain.max(axis=1)):
            p = int(gain[i].argmax())
            if gain[i, p] <= 0:
                break
            if size[p] < room:
                size[label[i]] -= 1
                size[p] += 1
                label[i], moved = p, moved + 1
        if not moved:
            break
    return label


class Router:
    """A network of one hidden layer: probabilities of the parts for unit vectors."""

    def __init__(self, x: np.ndarray, target: np.ndarray) -> None:
        rng = np.random.default_rng(11)
        sizes = [(x.shape[1], _HIDDEN), (_HIDDEN, target.shape[1])]
        self.w = [rng.normal(0, (2 / a) ** 0.5, (a, b)) for a, b in sizes] + [np.zeros(b) for _, b in sizes]
        first, second, step = [np.zeros_like(w) for w in self.w], [np.zeros_like(w) for w in self.w], 0
        for _ in range(_EPOCHS if target.shape[1] > 1 else 0):
            order = rng.permutation(len(x))
            for a in range(0, len(x), _BATCH):
                own, step = order[a : a + _BATCH], step + 1
                inner = np.maximum(x[own] @ self.w[0] + self.w[2], 0)
                error = (self._soft(inner @ self.w[1] + self.w[3]) - target[own]) / len(own)
                back = (error @ self.w[1].T) * (inner > 0)
                slopes = [x[own].T @ back + 1e-4 * self.w[0], inner.T @ error + 1e-4 * self.w[1], back.sum(axis=0), error.sum(axis=0)]
                for k, g in enumerate(slopes):  # Adam
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    self.w[k] -= 2e-3 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)

    @staticmethod
    def _soft(z: np.ndarray) -> np.ndarray:
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self._soft(np.maximum(x @ self.w[0] + self.w[2], 0) @ self.w[1] + self.w[3])

    def ranking(self, x: np.ndarray) -> np.ndarray:
        """Parts of each vector, most probable first."""
        return np.argsort(-self(x), axis=1, kind="stable")


def fit(x: np.ndarray, k: int, parts: int, target_recall: float) -> tuple[Router, int]:
    """The router and the number of parts to probe, from unit vectors."""
    parts = max(1, parts)
    if parts == 1:
        return Router(x, np.ones((len(x), 1))), 1
    graph = neighbour_graph(x, _NEIGHBOURS)
    label = balanced_parts(x, graph, parts)
    soft = np.eye(parts)[label] + np.eye(parts)[label[graph]].sum(axis=1)
    soft /= soft.sum(axis=1, keepdims=True)
    # Vectors the network has not seen tell how many probes it takes; it is then fitted on all.
    held = np.arange(len(x)) % 4 == 0
    trial = Router(x[~held], soft[~held])
    own = trial.ranking(x)[:, 0]
    near = neighbour_graph(x, k)[held]
    order = trial.ranking(x[held])
    place = np.argsort(order, axis=1)  # at which probe each part is reached
    reached = np.take_along_axis(place, own[near], axis=1)
    probes = next(p for p in range(1, parts + 1) if (reached < p).mean() >= target_recall or p == parts)
    return Router(x, soft), probes


# --- searching ------------------------------------------------------------------------

def _valid(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and vectors, as doubles, that take part: of the right size, finite, not zero."""
    rows, vectors = [], []
    for i, v in enumerate(column.to_pylist()):
        if v is not None and len(v) == size and None not in v:
            x = np.array(v, np.float64)
            if np.isfinite(x).all() and x.any() and 0 < (x * x).sum() < np.inf:
                rows.append(i)
                vectors.append(x)
    return np.array(rows, np.int64), np.array(vectors, np.float64).reshape(-1, size)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def nearest_in_block(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple[int, int, float]]:
    """(query id, vec_id, cosine) of the k nearest other ids in a block, ties to the smaller id.

    The matrix product only preselects, with room for its rounding; cosines are then taken pair by
    pair, so that equal vectors have equal scores.
    """
    query_norms, norms = (np.sqrt((x * x).sum(axis=1)) for x in (queries, rows))
    units = rows / norms[:, None]
    for a in range(0, len(queries), 128):
        rough = (queries[a : a + 128] / query_norms[a : a + 128, None]) @ units.T
        for q, scores in enumerate(rough, a):
            scores[ids == query_ids[q]] = -np.inf
            wanted = min(k, len(ids))
            while True:
                least = np.partition(scores, -wanted)[-wanted]
                some = np.flatnonzero((scores >= least - 1e-9) & (scores > -np.inf))
                if wanted == len(ids) or len(np.unique(ids[some])) >= k:
                    break
                wanted = min(2 * wanted, len(ids))
            exact = (rows[some] * queries[q]).sum(axis=1) / (norms[some] * query_norms[q])
            met: set[int] = set()
            for i in np.lexsort((ids[some], -exact)):
                found = int(ids[some[i]])
                if found not in met:
                    met.add(found)
                    yield int(query_ids[q]), found, float(exact[i])
                    if len(met) == k:
                        break


def _packed(group: list[str], id_column: str):
    """Rows of a group as one row of bytes."""

    def run(t: pa.Table) -> pa.Table:
        ids = t["id"].to_numpy()
        columns = [pa.array([t[c][0].as_py()], pa.int32()) for c in group]
        matrix = pa.array([b"".join(t["vector"].to_pylist())], pa.binary())
        return pa.Table.from_arrays([*columns, pa.array([ids.tobytes()], pa.binary()), matrix], names=[*group, f"{id_column}_ids", f"{id_column}_matrix"])

    return run


def nearest(
    vectors: DataFrame, every: int = 50, k: int = 5, sample: int = SAMPLE, parts: int | None = None, target_recall: float = TARGET_RECALL
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest found for each row whose vec_id `every` divides.

    All rows are indexed. Null or zero vectors, those with null or non-finite components, of another
    length than most (ties: the shorter), or without a vec_id take no part. Rows of one vec_id are one
    item, found by its nearest row and never its own neighbour. With fewer candidates all are
    returned. Other columns are not looked at.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").alias("v")).where("id IS NOT NULL AND size(v) > 0")
    sizes = rows.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").first()
    size = sizes.size if sizes else 1
    # As large a part of all hashes as makes about `sample` vectors, so that a task sends only its share.
    highest = -(2**63) + min(1.0, sample / max(1, sizes.n if sizes else 0)) * 2.0**64
    low = rows.where((F.size("v") == size) & (F.xxhash64("v") <= F.lit(highest)))
    picked = low.select("v").distinct().limit(2 * sample).toArrow()
    x = _unit(_valid(picked["v"].combine_chunks() if len(picked) else pa.array([], pa.list_(pa.float64())), size)[1])
    x = x[np.lexsort(x.T)][np.random.default_rng(5).permutation(len(x))]  # in one order, whatever order they came in
    router, probes = fit(x, k, parts or len(x) // _PER_PART, target_recall) if len(x) > 1 else (Router(np.zeros((1, size)), np.ones((1, 1))), 1)
    shared = spark.sparkContext.broadcast(router)
    n_parts = len(router.w[3])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in (batch.slice(i, 2_000) for i in range(0, len(batch), 2_000)):
                at, vectors_ = _valid(piece["v"], size)
                if len(at):
                    ranking = shared.value.ranking(_unit(vectors_))[:, :probes].astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [piece["id"].take(pa.array(at)), pa.array([v.tobytes() for v in vectors_], pa.binary()), pa.array(list(ranking), pa.list_(pa.int32()))],
                        ["id", "vector", "parts"],
                    )

    # Routed once; the counts below and both sides of the search read the same rows.
    dealt = stored(rows.mapInArrow(deal, "id long, vector binary, parts array<int>"))
    is_query = F.col("id") % every == 0
    n, n_queries = dealt.agg(F.count("*"), F.coalesce(F.sum(is_query.cast("long")), F.lit(0))).first()
    blocks = max(1, -(-n // (n_parts * _BLOCK_ROWS)))
    query_blocks = max(1, -(-n_queries * probes // (n_parts * _BLOCK_QUERIES)))
    spread = lambda m: F.pmod(F.xxhash64("id"), F.lit(m)).cast("int")
    base = dealt.select("id", "vector", F.get("parts", F.lit(0)).alias("part"), spread(blocks).alias("block"))
    asked = dealt.where(is_query).select("id", "vector", F.explode("parts").alias("part"), spread(query_blocks).alias("query_block"))
    base = base.groupBy("part", "block").applyInArrow(_packed(["part", "block"], "row"), "part int, block int, row_ids binary, row_matrix binary")
    asked = asked.groupBy("part", "query_block").applyInArrow(
        _packed(["part", "query_block"], "query"), "part int, query_block int, query_ids binary, query_matrix binary"
    )
    every_block = lambda m, name: F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias(name)
    cells = base.select("*", every_block(query_blocks, "query_block")).join(
        asked.select("*", every_block(blocks, "block")), ["part", "block", "query_block"]
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (batch.slice(i, 1) for i in range(len(batch))):
                row_ids, row_matrix, query_ids, query_matrix = (row[c][0].as_buffer() for c in ("row_ids", "row_matrix", "query_ids", "query_matrix"))
                found = list(nearest_in_block(
                    np.frombuffer(query_matrix, np.float64).reshape(-1, size), np.frombuffer(query_ids, np.int64),
                    np.frombuffer(row_matrix, np.float64).reshape(-1, size), np.frombuffer(row_ids, np.int64), k,
                ))
                if found:
                    q, v, s = zip(*found)
                    yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(v, pa.int64()), pa.array(s, pa.float64())], ["query_id", "vec_id", "score"])

    found = cells.mapInArrow(search, "query_id long, vec_id long, score double").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


@query()
def op7_nearest_neighbours(spark, sf_dir):
    """The 5 nearest found for every fiftieth vector."""
    return nearest(table(spark, sf_dir, "embeddings"))

"""Exact top-k search by inner product: distributed histogram selection (operator 2).

Queries are taken in blocks of bounded size. For a block, every candidate is
scored against every query, but no score leaves its task: each task counts its
scores in 256 bins per query, and the summed histograms show in which bin a
query's k-th highest score lies. That bin is cut into 256 again, until it is
one score wide or few scores remain above its lower end. One last pass emits
the scores from there on, and ties at the k-th score go to the smaller ids.

Components are floor(1024 * x) as 64-bit integers. Products run as float64
matrix products where all sums stay below 2^53, which is exact, else as 64-bit
integers. Vectors so long that a score might not fit in 64 bits are refused.

Defined cases: vectors that are null, empty, or hold null or non-finite
components take no part; vectors are compared with vectors of their length
only; a row without id is never a query and ranks last among ties; rows that
repeat an id are separate candidates, none of them for that id's query, which
uses the smallest of its vectors; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimlake.llm.common import stored
from claimlake.session import scratch_path

SCALE = 1024
BINS = 256
#: Queries scored together: what is broadcast (2 MB at 64 components) and one task's histograms (8 MB) stay this small.
BLOCK = 2048
#: A query is refined until so many scores per wanted result remain, or its bin is one score wide.
SPARE = 16
#: Candidates scored at once.
ROWS = 1024


def integer_vectors(table: DataFrame, id_col: str, vector: str) -> DataFrame:
    """(id, v): the rows that take part, with components floor(1024 * x)."""
    x = F.col(vector)
    usable = x.isNotNull() & (F.size(x) > 0) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return table.select(F.col(id_col).alias("id"), F.when(usable, F.transform(x, lambda c: F.floor(c.cast("double") * SCALE).cast("long"))).alias("v")).where("v IS NOT NULL")


def _matrix(column: pa.ListArray, rows: np.ndarray) -> np.ndarray:
    return np.asarray(column.take(pa.array(rows)).flatten()).reshape(len(rows), -1)


def scores(batch: pa.RecordBatch, queries: dict[int, tuple[np.ndarray, np.ndarray]]):
    """For each length of vectors: query positions, candidate positions and their scores, ROWS candidates at a time."""
    vectors = batch.column("v")
    lengths = np.diff(np.asarray(vectors.offsets))
    for size, (at, q) in queries.items():
        rows = np.flatnonzero(lengths == size)
        for a in range(0, len(rows), ROWS):
            part = rows[a : a + ROWS]
            c = _matrix(vectors, part)
            high = float(np.abs(q.astype(float)).max()) * float(np.abs(c.astype(float)).max()) * size
            yield at, part, (q.astype(float) @ c.astype(float).T).astype(np.int64) if high < 2**53 else q @ c.T


def _own(ids: np.ndarray, batch: pa.RecordBatch, part: np.ndarray) -> np.ndarray:
    """Where a candidate is the query's own row."""
    known = batch.column("id").take(pa.array(part))
    return (ids[:, None] == np.asarray(known.fill_null(0))[None, :]) & np.asarray(known.is_valid())[None, :]


def _histograms(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, queries, low, width = shared.value
        counts = np.zeros((len(ids), BINS + 1), np.int64)  # the last one: above all bins
        for batch in batches:
            for at, part, s in scores(batch, queries):
                bin_ = np.clip((s - low[at, None]) // width[at, None], -1, BINS)
                bin_[_own(ids[at], batch, part)] = -1
                row, col = np.nonzero(bin_ >= 0)
                counts += np.bincount(at[row] * (BINS + 1) + bin_[row, col], minlength=counts.size).reshape(counts.shape)
        q, b = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(b, pa.int32()), pa.array(counts[q, b])], ["q", "bin", "n"])

    return run


def _emit(shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, queries, low, width = shared.value
        ties: dict[int, list] = defaultdict(list)  # of a query whose k-th score is known: its smallest ids
        for batch in batches:
            id_ = batch.column("id")
            for at, part, s in scores(batch, queries):
                keep = (s >= low[at, None]) & ~_own(ids[at], batch, part)
                tied = keep & (s == low[at, None]) & (width[at, None] == 1)
                for q in np.flatnonzero(tied.any(axis=1)):
                    got = id_.take(pa.array(part[tied[q]])).to_pylist()
                    ties[at[q]] = sorted(ties[at[q]] + got, key=lambda i: (i is None, i))[:k]
                row, col = np.nonzero(keep & ~tied)
                yield pa.RecordBatch.from_arrays([pa.array(ids[at[row]]), id_.take(pa.array(part[col])), pa.array(s[row, col])], ["query_id", "vec_id", "score"])
        flat = [(ids[q], i, low[q]) for q, some in ties.items() for i in some]
        yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in flat], pa.int64()) for j in range(3)], ["query_id", "vec_id", "score"])

    return run


def _refine(rows: DataFrame, ids: np.ndarray, queries: dict, low: np.ndarray, width: np.ndarray, k: int):
    """Histograms until each query's lower end leaves few scores, or is its k-th score."""
    context, open_ = rows.sparkSession.sparkContext, np.ones(len(ids), bool)
    while True:
        shared = context.broadcast((ids, queries, low, width))
        found = rows.mapInArrow(_histograms(shared), "q int, bin int, n long").groupBy("q", "bin").agg(F.sum("n").alias("n")).toArrow()
        counts = np.zeros((len(ids), BINS + 1), np.int64)  # at most BLOCK x BINS numbers reach the driver
        counts[np.asarray(found["q"]), np.asarray(found["bin"])] = np.asarray(found["n"])
        down = counts[:, ::-1].cumsum(axis=1)[:, ::-1]  # scores in this bin or above
        enough = down >= k
        at = np.where(enough.any(axis=1), BINS - np.argmax(enough[:, ::-1], axis=1), 0)
        at = np.minimum(at, BINS - 1)
        low = np.where(open_, low + at * width, low)
        open_ &= (down[np.arange(len(ids)), at] > SPARE * k) & (width > 1)
        if not open_.any():
            return low, width
        width = np.where(open_, -(-width // BINS), width)


def top_k(table: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k highest inner products of each query row."""
    rows = stored(integer_vectors(table, id_col, vector), "vectors")
    asked = stored(rows.where(F.col("id").isNotNull() & is_query(F.col("id"))).groupBy("id").agg(F.min("v").alias("v")), "queries")
    blocks = max(1, -(-asked.count() // BLOCK))
    longest = rows.agg(F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x))).first()[0]
    path = scratch_path(rows.sparkSession, "llm-top")
    for block in range(blocks):
        part = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block).orderBy("id").toArrow()  # about BLOCK rows
        ids, vectors = np.asarray(part["id"], dtype=np.int64), part["v"].to_pylist()
        by_size: dict[int, list[int]] = defaultdict(list)
        for i, v in enumerate(vectors):
            by_size[len(v)].append(i)
        queries = {n: (np.array(at), np.array([vectors[i] for i in at], np.int64)) for n, at in by_size.items()}
        reach = np.array([np.sqrt((np.array(v, float) ** 2).sum()) * np.sqrt(longest or 0) + 1 for v in vectors])
        if (reach >= 2.0**62).any():
            raise ValueError("components are too large: scores of these vectors may not fit in 64 bits")
        low = -np.ceil(reach).astype(np.int64) if len(ids) else np.zeros(0, np.int64)
        width = -(-(-2 * low + 1) // BINS) if len(ids) else np.ones(0, np.int64)
        if len(ids):
            low, width = _refine(rows, ids, queries, low, width, k)
        shared = rows.sparkSession.sparkContext.broadcast((ids, queries, low, width))
        found = rows.mapInArrow(_emit(shared, k), "query_id long, vec_id long, score long")
        order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
        found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        found.select("query_id", "rank", "vec_id", "score").write.parquet(f"{path}/block={block}")
    return rows.sparkSession.read.schema("query_id long, rank int, vec_id long, score long").parquet(f"{path}/block=*")

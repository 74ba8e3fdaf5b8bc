"""Exact top-k search with a vector-approximation file.

Vectors become integers, ``floor(256 * x)``; the score is their inner product,
the higher the nearer. The file holds, per chunk of vectors, the ids and the
quantised cells (``2 ** BITS`` cells of equal width between the least and the
greatest value of each dimension, counted over all vectors). Of equal vectors
only the ``k + 1`` smallest ids stand in it: no result holds more of them. A
search goes

1. over the cells: they give a lower and an upper bound of every score; the
   k-th highest lower bound over all chunks is a threshold no result lies below;
2. over the cells again: rows whose upper bound reaches the threshold are the
   candidates;
3. to the exact vectors of the candidates alone, by a join on the id. They are
   dealt by query and sorted by falling bound, behind the query's own vector;
   one iterator computes scores a few at a time until the k-th is above every
   bound that is left.

Queries come in blocks and meet chunks by an equi-join on the chunk, so a task
holds one block and one chunk of cells at a time; exact vectors move once per
candidate. Equal scores go to smaller ids.

Defined cases: vectors that are NULL, or hold a NULL or non-finite component,
and rows without an id take no part; a repeated id counts once (of different
vectors the greatest); vectors of different lengths have no score; fewer than
k candidates give all of them. Scores must fit into 64 bits. Extra columns
are not read.
"""

from __future__ import annotations

from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from selfmend.llm.common import map_arrow, materialised, ship_package

BITS = 8
CHUNK_ROWS = 1024
QUERY_ROWS = 256
#: Exact vectors looked at a time in step 3.
STEP = 16
#: Partial results held by a task before they are handed on.
HELD = 500_000


def integer_vectors(embeddings: DataFrame) -> DataFrame:
    """``vec_id, v, dim``: the vectors that take part, one row per id."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform("embedding", lambda x: F.floor(F.lit(256.0) * x.cast("double")))
    return (embeddings.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite)
            .select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"))
            .groupBy("vec_id").agg(F.max("v").alias("v")).withColumn("dim", F.size("v")))


def _blocks(vectors: DataFrame, rows: int, name: str) -> tuple[DataFrame, int]:
    """``dim, <name>, ids, vectors``: about ``rows`` vectors packed to a row."""
    n = max(1, -(-vectors.count() // rows))

    def pack(key: Any, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id")
        v = np.stack(pdf["v"].to_numpy()).astype(np.int64) if key[0] else np.zeros((len(pdf), 0), np.int64)
        return pd.DataFrame({"dim": [key[0]], name: [key[1]], "ids": [pdf["vec_id"].to_numpy(np.int64).tobytes()],
                             "vectors": [v.tobytes()]})

    packed = (vectors.withColumn(name, F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int"))
              .groupBy("dim", name).applyInPandas(pack, f"dim int, {name} int, ids binary, vectors binary"))
    return packed, n


def _cell_edges(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and the greatest value of each cell, per dimension."""
    cells, width = np.arange(1 << BITS)[:, None], high - low + 1
    first = low - (-(cells * width) >> BITS)                # rounded up
    return first, low - (-((cells + 1) * width) >> BITS) - 1


def approximation_file(vectors: DataFrame) -> tuple[DataFrame, int]:
    """``dim, chunk, ids, cells, marks`` per chunk, and how many chunks."""
    marks = (vectors.select("dim", F.posexplode("v").alias("at", "x")).groupBy("dim", "at")
             .agg(F.min("x").alias("low"), F.max("x").alias("high")).groupBy("dim")
             .agg(F.sort_array(F.collect_list(F.struct("at", "low", "high"))).alias("m"))
             .select("dim", F.col("m.low").alias("low"), F.col("m.high").alias("high")))
    chunks, n = _blocks(vectors, CHUNK_ROWS, "chunk")

    def quantise(frames):
        for pdf in frames:
            cells, edges = [], []
            for r in pdf.itertuples():
                low, high = np.asarray(r.low, np.int64), np.asarray(r.high, np.int64)
                v = np.frombuffer(r.vectors, np.int64).reshape(-1, r.dim)
                cells.append((((v - low) << BITS) // (high - low + 1)).astype(np.uint8).tobytes())
                edges.append(np.stack([low, high]).tobytes())
            yield pd.DataFrame({"dim": pdf["dim"], "chunk": pdf["chunk"], "ids": pdf["ids"], "cells": cells, "marks": edges})

    joined = chunks.where("dim > 0").join(materialised(marks, "marks"), "dim")
    return materialised(joined.mapInPandas(
        quantise, "dim int, chunk int, ids binary, cells binary, marks binary"), "va-file"), n


def _bounds(q: np.ndarray, cells: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the scores, queries by vectors. The sums are
    exact in double precision below 2**53; beyond, they are widened."""
    first, last = _cell_edges(marks[0], marks[1])
    at = np.arange(cells.shape[1])
    low, high = first[cells, at].astype(float), last[cells, at].astype(float)
    up, down = np.maximum(q, 0).astype(float), np.minimum(q, 0).astype(float)
    lower = up @ low.T + down @ high.T
    upper = up @ high.T + down @ low.T
    most = float((np.abs(q.astype(float)).max(axis=0) * np.maximum(np.abs(low), np.abs(high)).max(axis=0)).sum())
    slack = 0.0 if most < 2.0 ** 53 else most * 2.0 ** -40
    return lower - slack, upper + slack


class _Best:
    """The k best (value, smaller id first) of each query seen so far."""

    def __init__(self, k: int) -> None:
        self.k, self.held = k, {}

    def add(self, query: int, values: np.ndarray, ids: np.ndarray) -> None:
        if query in self.held:
            v, i = self.held[query]
            values, ids = np.concatenate([v, values]), np.concatenate([i, ids])
        order = np.lexsort((ids, -values))[:self.k]
        self.held[query] = values[order], ids[order]

    def frame(self, value: str) -> pd.DataFrame:
        n = [len(i) for _, i in self.held.values()]
        out = pd.DataFrame({"query_id": np.repeat(np.fromiter(self.held, np.int64, len(self.held)), n),
                            "vec_id": np.concatenate([i for _, i in self.held.values()]),
                            value: np.concatenate([v for v, _ in self.held.values()])})
        self.held = {}
        return out


class Visit:
    """One query's walk over its candidates, nearest bound first."""

    def __init__(self, query_id: int, q: np.ndarray, k: int) -> None:
        self.query_id, self.q, self.k = query_id, q, k
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.read, self.certain = 0, False

    def take(self, ids: np.ndarray, upper: np.ndarray, exact: np.ndarray) -> None:
        """Further candidates, bounds falling."""
        for at in range(0, len(ids), STEP):
            if self.certain or len(self.scores) >= self.k and self.scores[self.k - 1] > upper[at]:
                self.certain = True                     # no bound that is left reaches the k-th score
                return
            some = slice(at, at + STEP)
            self.read += len(ids[some])
            scores, found = np.concatenate([self.scores, exact[some] @ self.q]), np.concatenate([self.ids, ids[some]])
            order = np.lexsort((found, -scores))[:self.k]
            self.scores, self.ids = scores[order], found[order]


def _walk(k: int):
    def walk(batches):
        """Rows ``query_id, bound, vec_id, v`` sorted by query and falling
        bound; a query's own vector, without a bound, comes first."""
        visit, done = None, []

        def framed():
            n = [len(x.ids) for x in done]
            return pa.RecordBatch.from_pydict({
                "query_id": pa.array(np.repeat(np.array([x.query_id for x in done], np.int64), n)),
                "rank": pa.array(np.concatenate([np.arange(1, m + 1) for m in n] or [np.zeros(0)]), pa.int32()),
                "vec_id": pa.array(np.concatenate([x.ids for x in done] or [np.zeros(0)]), pa.int64()),
                "score": pa.array(np.concatenate([x.scores for x in done] or [np.zeros(0)]), pa.int64()),
                "n_read": pa.array(np.repeat(np.array([x.read for x in done], np.int64), n))})

        for b in batches:
            query = b.column("query_id").to_numpy()
            ids, v = b.column("vec_id").to_numpy(), b.column("v")
            bound = b.column("bound").to_numpy(zero_copy_only=False)
            edges = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]]) if len(query) else [])
            for first, last in zip(edges, np.append(edges[1:], len(query))):
                if visit is None or query[first] != visit.query_id:
                    done += [visit] if visit else []
                    visit = Visit(int(query[first]), np.array(v[int(first)].values, np.int64), k)
                    first += 1
                if last > first and not visit.certain:
                    own = v.slice(first, last - first)
                    visit.take(ids[first:last], bound[first:last], own.flatten().to_numpy().reshape(last - first, -1))
            yield framed()
            done = []
        if visit:
            done = [visit]
            yield framed()
    return walk


def search(embeddings: DataFrame, is_query: Column, k: int = 5, with_read: bool = False) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` highest scores of each
    row for which ``is_query`` (an expression over ``vec_id``) holds;
    ``with_read`` adds ``n_read``, how many exact vectors that query took."""
    ship_package(embeddings.sparkSession)
    vectors = materialised(integer_vectors(embeddings).where("dim > 0"), "vectors")
    among_equal = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    searched = materialised(vectors.withColumn("n", among_equal).where(F.col("n") <= k + 1).drop("n"), "searched")
    file, n_chunks = approximation_file(searched)
    queries = vectors.where(is_query)
    blocks, _ = _blocks(queries, QUERY_ROWS, "block")
    blocks = materialised(blocks, "queries")

    def meet(queries: DataFrame, columns: list[str]) -> DataFrame:
        spread = queries.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))))
        own = file.select("dim", "chunk", F.col("ids").alias("chunk_ids"), *columns)
        return spread.join(own.hint("merge"), ["dim", "chunk"])     # never broadcast: both sides grow

    def cells_of(r) -> np.ndarray:
        return np.frombuffer(r.cells, np.uint8).reshape(-1, r.dim)

    def scan(frames):
        best = _Best(k)
        for pdf in frames:
            for r in pdf.itertuples():
                q_ids, q = np.frombuffer(r.ids, np.int64), np.frombuffer(r.vectors, np.int64).reshape(-1, r.dim)
                ids = np.frombuffer(r.chunk_ids, np.int64)
                lower, _ = _bounds(q, cells_of(r), np.frombuffer(r.marks, np.int64).reshape(2, -1))
                lower[q_ids[:, None] == ids[None, :]] = -np.inf
                m = min(k, len(ids))
                top = np.argpartition(-lower, m - 1, axis=1)[:, :m]
                for i, query in enumerate(q_ids.tolist()):
                    own = top[i][np.isfinite(lower[i, top[i]])]
                    best.add(query, lower[i, own], ids[own])
                if len(best.held) * k > HELD:
                    yield best.frame("bound")
        if best.held:
            yield best.frame("bound")

    bounds = meet(blocks, ["cells", "marks"]).mapInPandas(scan, "query_id long, vec_id long, bound double")
    ranked = bounds.withColumn("n", F.row_number().over(
        Window.partitionBy("query_id").orderBy(F.desc("bound"), "vec_id")))
    threshold = ranked.where(F.col("n") <= k).groupBy("query_id").agg(
        F.when(F.count("*") == k, F.min("bound")).alias("threshold"))
    # a block's thresholds go with it: as many as it has queries
    with_block = queries.select("vec_id", "dim").join(threshold, F.col("vec_id") == F.col("query_id"))
    n_blocks = max(1, -(-queries.count() // QUERY_ROWS))
    limits = with_block.groupBy("dim", F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).cast("int").alias("block")) \
        .agg(F.collect_list(F.struct("query_id", "threshold")).alias("limits"))
    blocks = materialised(blocks.join(limits, ["dim", "block"], "left"), "queries")

    def reach(frames):
        for pdf in frames:
            for r in pdf.itertuples():
                q_ids, q = np.frombuffer(r.ids, np.int64), np.frombuffer(r.vectors, np.int64).reshape(-1, r.dim)
                ids = np.frombuffer(r.chunk_ids, np.int64)
                _, upper = _bounds(q, cells_of(r), np.frombuffer(r.marks, np.int64).reshape(2, -1))
                limit = {x["query_id"]: x["threshold"] for x in (r.limits if r.limits is not None else [])}
                least = np.array([limit.get(x) for x in q_ids.tolist()], dtype=float)       # None: fewer than k rows, all are
                near = (upper >= np.where(np.isnan(least), -np.inf, least)[:, None]) & (q_ids[:, None] != ids[None, :])
                i, j = np.nonzero(near)
                yield pd.DataFrame({"query_id": q_ids[i], "vec_id": ids[j], "bound": upper[i, j]})

    candidates = meet(blocks, ["cells", "marks"]).mapInPandas(reach, "query_id long, vec_id long, bound double")
    exact = candidates.join(searched.select("vec_id", "v").hint("merge"), "vec_id").select("query_id", "bound", "vec_id", "v")
    own = queries.select(F.col("vec_id").alias("query_id"), F.lit(None).cast("double").alias("bound"), "vec_id", "v")
    dealt = own.unionByName(exact).repartition("query_id") \
        .sortWithinPartitions("query_id", F.desc_nulls_first("bound"), "vec_id")
    out = map_arrow(dealt, _walk(k), "query_id long, rank int, vec_id long, score long, n_read long")
    return out if with_read else out.drop("n_read")


#: The same result in SQL: every query against every row.
ORACLE = """
WITH v AS (SELECT vec_id, max(list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE)))) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 GROUP BY vec_id),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5
"""

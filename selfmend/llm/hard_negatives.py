"""Hard-negative mining by secondary sort.

An anchor's positives are its nearest rows of the same label, the hard
negatives of a positive the nearest rows of another label whose score lies
within a window of shares of the positive's score. Vectors become integers,
``floor(256 * x)``; the score is their inner product, the higher the nearer.

Anchors come in blocks and meet chunks of rows by an equi-join on the chunk;
a task holds one block and one chunk at a time. Two scans:

1. each (anchor, chunk) hands on its best rows of the anchor's label, from
   which the anchor's positives are ranked;
2. each (anchor, chunk) hands on, for each positive, the best rows of other
   labels inside its window, as many as a window may take.

What a chunk holds back cannot be among the results, as the same chunk has
enough better rows. The pairs, keyed ``(anchor, falling score, other label,
id)``, are shuffled by anchor and sorted within their partition by the whole
key. One iterator then walks each partition: a row of the anchor's label opens
a window, a row of another label goes to every open window it lies in, and a
window that is full or left behind is closed. No anchor is ever held: the
state is its open windows. At equal scores positives come first, so that a
window is open before rows of its own score (a score of 0) pass.

Defined cases: rows with a NULL id, label or vector, or with a NULL or
non-finite component or no component take no part; a repeated id counts once
(its greatest vector, then label); vectors of different lengths have no score;
fewer positives or negatives than asked for give all of them; a negative
positive score has an empty window. 100 times a score must fit into 64 bits.
Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from selfmend.llm.common import materialised, ship_package

CHUNK_ROWS = 4096
BLOCK_ROWS = 256
POSITIVES = 5
NEGATIVES = 10
#: Bounds of a negative's score, in hundredths of the positive's.
LOW, HIGH = 30, 90


def rows_taking_part(embeddings: DataFrame) -> DataFrame:
    """``vec_id, label, v, dim``: one row per id, its vector in integers."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform("embedding", lambda x: F.floor(F.lit(256.0) * x.cast("double")))
    return (embeddings.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0) & finite)
            .select(F.col("vec_id").cast("long").alias("vec_id"), F.struct(whole.alias("v"), F.col("label").cast("long").alias("label")).alias("own"))
            .groupBy("vec_id").agg(F.max("own").alias("own"))
            .select("vec_id", "own.label", "own.v", F.size("own.v").alias("dim")))


def _packed(rows: DataFrame, size: int, name: str) -> tuple[DataFrame, int]:
    """``dim, <name>, ids, labels, vectors``: about ``size`` rows packed to one."""
    n = max(1, -(-rows.count() // size))

    def pack(key: Any, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id")
        return pd.DataFrame({"dim": [key[0]], name: [key[1]], "ids": [pdf["vec_id"].to_numpy(np.int64).tobytes()],
                             "labels": [pdf["label"].to_numpy(np.int64).tobytes()],
                             "vectors": [np.stack(pdf["v"].to_numpy()).astype(np.int64).tobytes()]})

    schema = f"dim int, {name} int, ids binary, labels binary, vectors binary"
    packed = (rows.withColumn(name, F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int"))
              .groupBy("dim", name).applyInPandas(pack, schema))
    return materialised(packed, name), n


def scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """All inner products, exact: in doubles where every sum stays below 2**53."""
    most = float((np.abs(q.astype(float)).max(axis=0) * np.abs(v.astype(float)).max(axis=0)).sum())
    if most < 2.0 ** 53:
        return np.rint(q.astype(float) @ v.T.astype(float)).astype(np.int64)
    return q @ v.T


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` highest scores, ties to smaller ids; ``ids`` ascend."""
    if len(score) > 4 * k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        near = np.flatnonzero(score >= least)
        return near[np.lexsort((ids[near], -score[near]))[:k]]
    return np.lexsort((ids, -score))[:k]


def chunk_positives(anchors, rows, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of each anchor of a block: scores and ids of the chunk's best rows of its label."""
    (a_ids, a_labels, a), (ids, labels, v) = anchors, rows
    score = scores(a, v)
    for i, anchor in enumerate(a_ids.tolist()):
        own = np.flatnonzero((labels == a_labels[i]) & (ids != anchor))
        if len(own):
            top = own[_best(score[i, own], ids[own], k)]
            yield anchor, score[i, top], ids[top]


def chunk_negatives(anchors, rows, positives: dict[int, list[int]], k: int,
                    low: int, high: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of each anchor of a block: scores and ids of the rows of other labels
    that are among the chunk's best ``k`` in the window of some positive."""
    (a_ids, a_labels, a), (ids, labels, v) = anchors, rows
    score = scores(a, v)
    for i, anchor in enumerate(a_ids.tolist()):
        windows = [p for p in positives.get(anchor, ()) if p >= 0]
        if not windows:
            continue
        s = 100 * score[i]
        other = np.flatnonzero((labels != a_labels[i]) & (s <= high * max(windows)) & (s >= low * min(windows)))
        other = other[np.lexsort((ids[other], -s[other]))]
        chosen = np.zeros(len(other), dtype=bool)
        for p in windows:       # falling scores: the window's rows are a run of them
            first = np.searchsorted(-s[other], -high * p)
            last = np.searchsorted(-s[other], -low * p, side="right")
            chosen[first:min(last, first + k)] = True
        if chosen.any():
            yield anchor, score[i, other[chosen]], ids[other[chosen]]


class Windows:
    """The walk over pairs sorted by (anchor, falling score, other label, id)."""

    def __init__(self, positives: int, negatives: int, low: int, high: int) -> None:
        self.positives, self.negatives, self.low, self.high = positives, negatives, low, high
        self.anchor, self.seen, self.open = None, 0, []

    def take(self, anchor: int, score: int, other: bool, row: int) -> Iterator[tuple]:
        if anchor != self.anchor:
            self.anchor, self.seen, self.open = anchor, 0, []
        if not other:
            if self.seen < self.positives:
                self.seen += 1
                self.open.append([row, score, 0])
            return
        if not self.open:
            return
        left = []
        for window in self.open:
            positive, high, n = window
            if self.low * high > 100 * score:
                continue                                # left behind: scores only fall
            if 100 * score <= self.high * high:
                window[2] = n = n + 1
                yield anchor, positive, n, row, high, score
            if n < self.negatives:
                left.append(window)
        self.open = left


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def negatives_of(pairs: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES,
                 low: int = LOW, high: int = HIGH) -> DataFrame:
    """The hard negatives in pairs ``anchor, id, score, other``: the secondary sort and the walk."""
    ship_package(pairs.sparkSession)
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]

    def walk(frames):
        windows = Windows(positives, negatives, low, high)
        for pdf in frames:
            found = [x for row in zip(pdf["anchor"].tolist(), pdf["score"].tolist(), pdf["other"].tolist(), pdf["id"].tolist())
                     for x in windows.take(*row)]
            yield pd.DataFrame(found, columns=names)

    keyed = pairs.select("anchor", F.negative("score").alias("down"), "other", "id")
    dealt = keyed.repartition("anchor").sortWithinPartitions("anchor", "down", "other", "id")
    return dealt.select("anchor", F.negative("down").alias("score"), "other", "id").mapInPandas(walk, RESULT)


def mine(embeddings: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score`` for the rows for which ``is_anchor`` (an expression over
    ``vec_id``) holds."""
    ship_package(embeddings.sparkSession)
    rows = materialised(rows_taking_part(embeddings), "rows")
    chunks, n_chunks = _packed(rows, CHUNK_ROWS, "chunk")
    anchors = materialised(rows.where(is_anchor), "anchors")
    blocks, n_blocks = _packed(anchors, BLOCK_ROWS, "block")

    def meet(queries: DataFrame) -> DataFrame:
        spread = queries.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))))
        own = chunks.select("dim", "chunk", *[F.col(c).alias(f"chunk_{c}") for c in ("ids", "labels", "vectors")])
        return spread.join(own.hint("merge"), ["dim", "chunk"])     # never broadcast: both sides grow

    def sides(r):
        def read(ids, labels, vectors):
            return (np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64),
                    np.frombuffer(vectors, np.int64).reshape(-1, r.dim))
        return read(r.ids, r.labels, r.vectors), read(r.chunk_ids, r.chunk_labels, r.chunk_vectors)

    def framed(found):
        found = list(found)
        n = [len(x[2]) for x in found]
        return pd.DataFrame({"anchor": np.repeat(np.array([x[0] for x in found], np.int64), n),
                             "id": np.concatenate([x[2] for x in found] or [np.zeros(0, np.int64)]),
                             "score": np.concatenate([x[1] for x in found] or [np.zeros(0, np.int64)])})

    def first_scan(frames):
        for pdf in frames:
            for r in pdf.itertuples():
                yield framed(chunk_positives(*sides(r), positives))

    near = meet(blocks).mapInPandas(first_scan, "anchor long, id long, score long")
    rank = F.row_number().over(Window.partitionBy("anchor").orderBy(F.desc("score"), "id"))
    ranked = materialised(near.withColumn("n", rank).where(F.col("n") <= positives).select("anchor", "id", "score"), "positives")
    # a block's positives go with it: as many as its anchors have
    held = (ranked.join(anchors.select(F.col("vec_id").alias("anchor"), "dim").hint("merge"), "anchor")
            .groupBy("dim", F.pmod(F.xxhash64("anchor"), F.lit(n_blocks)).cast("int").alias("block"))
            .agg(F.collect_list(F.struct("anchor", "score")).alias("positives")))
    blocks = materialised(blocks.join(held, ["dim", "block"]), "blocks")

    def second_scan(frames):
        for pdf in frames:
            for r in pdf.itertuples():
                own: dict[int, list[int]] = {}
                for x in r.positives:
                    own.setdefault(x["anchor"], []).append(x["score"])
                yield framed(chunk_negatives(*sides(r), own, negatives, low, high))

    others = meet(blocks).mapInPandas(second_scan, "anchor long, id long, score long")
    pairs = ranked.withColumn("other", F.lit(False)).unionByName(others.withColumn("other", F.lit(True)))
    return negatives_of(pairs, positives, negatives, low, high)


#: The same result in SQL: every anchor against every row; labels as the query sets them.
ORACLE = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS (SELECT vec_id, max(struct_pack(v := v, label := label)) AS own FROM e GROUP BY vec_id),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, c.own.label = a.own.label AS alike,
             CAST(list_inner_product(a.own.v, c.own.v) AS BIGINT) AS score
      FROM v a JOIN v c ON c.vec_id <> a.vec_id AND len(c.own.v) = len(a.own.v) WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE alike
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
r AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
             row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS n
      FROM p JOIN s USING (anchor_id) WHERE NOT s.alike AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(n AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM r WHERE n <= 10
"""

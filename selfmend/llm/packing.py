"""Best-fit packing by length histogram.

Documents become pieces of at most ``capacity`` tokens. The plan is made over
the histogram of piece lengths alone (at most ``capacity`` counts, whatever
the corpus size): best-fit decreasing places a whole count of equal lengths
at a time and yields runs ``(length, first_rank, n, per_bin, first_sequence,
offset)``. Pieces then take the planned slots by joining on length and rank
within length, so no document passes through the driver.

The rank within a length is an offset per (length, salt) plus a row number
inside that salt group, so that one length held by a third of all pieces is
still numbered in many tasks.

Defined cases: a NULL or empty text is one piece that holds the end token
only; repeated rows are packed once per row; other columns are never read.
A limit: words are told apart by a 64-bit hash and their length, not by their
bytes, so of two words that collide (one chance in 10**19 a pair) the second
would get the ids of the first.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from selfmend.llm.common import map_arrow, materialised, run_hashes, runs, text_slices, utf8

CAPACITY = 2048
END_ID = 0
#: Places of the worker's memory of words (a power of two); a new word takes the place of an old one.
PLACES = 1 << 20
#: Token ids held by that memory at most; beyond it the memory is emptied.
HELD_IDS = 3_000_000
#: Longer words are encoded anew each time.
CACHED_LENGTH = 64
#: New words encoded in one string.
WORDS_A_LINE = 1024
#: Pieces of one length are numbered in groups of about this many.
RANK_GROUP = 5_000
_SALTS = 1 << 20
_PIECES = "doc_id {id}, piece int, start long, length long, ids_crc32 long, salt int"


class WordEncoder:
    """Token ids of texts by a ``tokenizers`` file, remembered per word.

    White space never ends up in a token of this kind of vocabulary, so the
    ids of a text are those of its blank-separated words in order. Words are
    told apart by 64-bit hash and length, all of a batch at once in numpy, and
    their ids looked up in a table of fixed size. New words are encoded many
    at a time; each pre-token ends in a token that carries the end-of-word
    suffix, which gives the words' bounds back.
    """

    def __init__(self, path: str) -> None:
        import json
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.encode_batch = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        suffix = spec["model"].get("end_of_word_suffix") or ""
        vocab = spec["model"]["vocab"]
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends[[i for x, i in vocab.items() if suffix and x.endswith(suffix)]] = True
        self.blank = np.zeros(256, dtype=bool)
        self.blank[list(b" \t\n\v\f\r")] = True
        self._forget()

    def _forget(self) -> None:
        self.key = np.zeros(PLACES, dtype=np.uint64)
        self.entry = np.full(PLACES, -1, dtype=np.int64)
        self.size = np.zeros(0, dtype=np.int64)     # of each entry: bytes of the word,
        self.first = np.zeros(0, dtype=np.int64)    # first id in the pool and how many
        self.count = np.zeros(0, dtype=np.int64)
        self.pool = np.zeros(0, dtype="<u4")

    def _learn(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        """New words with their ids (little-endian unsigned 32-bit)."""
        # words of one pre-token, or of one and a full stop or comma: many to a call
        plain = [w for w in words if w.isalpha()]
        count = [1] * len(plain)
        marked = [w for w in words if w[-1] in ".," and w[:-1].isalpha()]
        plain += marked
        count += [2] * len(marked)
        lines = [plain[i:i + WORDS_A_LINE] for i in range(0, len(plain), WORDS_A_LINE)]
        rest = [w for w in words if not w.isalpha() and not (w[-1] in ".," and w[:-1].isalpha())]
        for n, found in enumerate(self.encode_batch([" ".join(x) for x in lines], add_special_tokens=False)):
            line = lines[n]
            ids = np.array(found.ids, dtype="<u4")
            bounds = np.flatnonzero(self.ends[ids]) + 1
            pre_tokens = np.cumsum(count[n * WORDS_A_LINE:n * WORDS_A_LINE + len(line)])
            if not len(bounds) or pre_tokens[-1] != len(bounds) or bounds[-1] != len(ids):
                rest += line        # lower case or composition made other pre-tokens: word by word
                continue
            ends = (4 * bounds[pre_tokens - 1]).tolist()
            data = ids.tobytes()
            yield from zip(line, [data[i:j] for i, j in zip([0, *ends], ends)])
        for word, found in zip(rest, self.encode_batch(rest, add_special_tokens=False)):
            yield word, np.array(found.ids, dtype="<u4").tobytes()

    def _entries(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The memory's entry of each word; new words are encoded and remembered."""
        if len(self.pool) > HELD_IDS:
            self._forget()
        size = ends - starts
        keys = run_hashes(buf, starts, ends)
        places = (keys >> np.uint64(64 - PLACES.bit_length() + 1)).astype(np.int64)
        found = self.entry[places]
        miss = np.flatnonzero((found < 0) | (self.key[places] != keys) | (self._size_of(found) != size))
        if len(miss):
            _, one, back = np.unique(keys[miss], return_index=True, return_inverse=True)
            own = miss[one]
            raw = buf.tobytes() if len(own) > 64 else None
            words = [(raw[a:b] if raw is not None else buf[a:b].tobytes()).decode("utf-8")
                     for a, b in zip(starts[own].tolist(), ends[own].tolist())]
            ids = dict(self._learn(words))
            ids = [ids[w] for w in words]
            count = np.array([len(x) for x in ids], dtype=np.int64) // 4
            at = len(self.size) + np.arange(len(own))
            self.first = np.concatenate([self.first, len(self.pool) + np.cumsum(count) - count])
            self.count = np.concatenate([self.count, count])
            self.size = np.concatenate([self.size, size[own]])
            self.pool = np.concatenate([self.pool, np.frombuffer(b"".join(ids), dtype="<u4")])
            found[miss] = at[back]
            short = size[own] <= CACHED_LENGTH
            self.key[places[own[short]]] = keys[own[short]]
            self.entry[places[own[short]]] = at[short]
        return found

    def _size_of(self, entries: np.ndarray) -> np.ndarray:
        return self.size[np.maximum(entries, 0)] if len(self.size) else np.full(len(entries), -1)

    def encode(self, column) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of an Arrow column, one after another, and the
        texts' edges in them."""
        buf, edges = utf8(column)
        starts, ends = runs(~self.blank[buf], edges)
        found = self._entries(buf, starts, ends)
        count = self.count[found]
        before = np.concatenate([[0], np.cumsum(count)])
        ids = self.pool[np.repeat(self.first[found] - before[:-1], count) + np.arange(before[-1])]
        return ids, before[np.searchsorted(starts, edges)]


_encoders: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, salt``
    and, ``with_ids``, its token ``ids``."""
    id_type = docs.schema["doc_id"].dataType

    def cut(batches):
        encoder, count = _encoder(tokenizer), 0
        end = np.array([END_ID], dtype="<u4").tobytes()
        for part in text_slices(batches):
            rows: list[tuple] = []
            at: list[int] = []
            held: list[np.ndarray] = []
            all_ids, edges = encoder.encode(part.column("text"))
            for i in range(part.num_rows):
                ids = all_ids[edges[i]:edges[i + 1]].tobytes() + end
                for k in range(0, len(ids), 4 * capacity):
                    own = ids[k:k + 4 * capacity]
                    rows.append((k // (4 * capacity), k // 4, len(own) // 4, zlib.crc32(own), count % _SALTS))
                    at.append(i)
                    if with_ids:
                        held.append(np.frombuffer(own, dtype="<u4").astype(np.int32))
                    count += 1
            piece, start, length, crc, salt = zip(*rows)
            ids = [pa.array(held, pa.list_(pa.int32()))] if with_ids else []
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(pa.array(at)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(salt, pa.int32()), *ids],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "salt"] + ["ids"] * with_ids)

    return map_arrow(docs.select("doc_id", "text"), cut,
                     _PIECES.format(id=id_type.simpleString()) + ", ids array<int>" * with_ids)


@dataclass(frozen=True)
class Run:
    """``n`` pieces of one length, from ``first_rank``: ``per_bin`` of them in
    a sequence, from sequence ``first_sequence`` on, the first at ``offset``."""
    length: int
    first_rank: int
    n: int
    per_bin: int
    first_sequence: int
    offset: int


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Run]:
    """Best-fit decreasing over counts. Equal lengths go together into the
    open sequences with the least room that still takes one, as many to each
    as fit; what is left opens new sequences. The open sequences are kept as
    ranges of equal room, so the work depends on the lengths, not on counts."""
    room: dict[int, list[tuple[int, int]]] = {}     # free tokens -> [(first sequence, how many)]
    runs: list[Run] = []
    opened = 0
    for length in sorted(histogram, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} tokens does not fit into {capacity}")
        left, rank = histogram[length], 0
        while left:
            free = min((r for r in room if r >= length), default=None)
            if free is None:
                need = -(-left // (capacity // length))
                room.setdefault(capacity, []).append((opened, need))
                opened += need
                continue
            first, n = room[free].pop()
            if not room[free]:
                del room[free]
            per = free // length
            full, over = divmod(min(left, n * per), per)
            runs.append(Run(length, rank, full * per + over, per, first, capacity - free))
            rank += full * per + over
            left -= full * per + over
            used = full + bool(over)
            for rest, start, many in ((free - per * length, first, full), (free - over * length, first + full, int(over > 0)),
                                      (free, first + used, n - used)):
                if many and rest:
                    room.setdefault(rest, []).append((start, many))
    return runs


_RUN = T.StructType([T.StructField(n, T.LongType(), False) for n in
                     ("r_length", "first_rank", "n", "per_bin", "first_sequence", "base")])


def place(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut`` (materialised pieces) with ``sequence_id`` and ``offset``;
    ``ids`` go along if it has them."""
    spark = cut.sparkSession
    histogram = {r["length"]: r["n"] for r in                       # at most ``capacity`` rows
                 cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    groups = max(1, -(-sum(histogram.values()) // RANK_GROUP))
    runs = spark.createDataFrame([(r.length, r.first_rank, r.n, r.per_bin, r.first_sequence, r.offset)
                                  for r in plan(histogram, capacity)], _RUN)
    salted = cut.withColumn("__group", F.pmod(F.xxhash64("doc_id", "salt"), F.lit(groups)))
    # ranks: rows of a group by order, groups one after another
    counts = salted.groupBy("length", "__group").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("length").orderBy("__group").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "__group", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("length", "__group").orderBy("doc_id", "piece", "ids_crc32", "salt")
    ranked = (salted.withColumn("__row", F.row_number().over(inside) - 1)
              .join(starts, ["length", "__group"]).withColumn("__rank", F.col("__before") + F.col("__row")))
    # the plan is bounded by the lengths, not by the corpus
    taken = ranked.join(F.broadcast(runs), (F.col("length") == F.col("r_length"))
                        & (F.col("__rank") >= F.col("first_rank"))
                        & (F.col("__rank") < F.col("first_rank") + F.col("n")))
    within = F.col("__rank") - F.col("first_rank")
    return taken.select("doc_id", "piece", "start", "length", "ids_crc32",
                        (F.col("first_sequence") + F.expr("(__rank - first_rank) div per_bin")).alias("sequence_id"),
                        (F.col("base") + F.pmod(within, F.col("per_bin")) * F.col("length")).alias("offset"),
                        *[n for n in ("ids",) if n in cut.columns])


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    return place(materialised(pieces(docs, tokenizer, capacity), "pieces"), capacity)


def sequences(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """The filled sequences: ``sequence_id`` and the token ``ids`` of its
    pieces, in order of their offsets (``capacity`` at most)."""
    placed = place(materialised(pieces(docs, tokenizer, capacity, with_ids=True), "pieces"), capacity)
    own = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(F.flatten(F.transform(own, lambda x: x["ids"])).alias("ids"))

"""MinHash near-dedup: improved consistent weighted sampling over TF-IDF
weighted word shingles, banded, verified by weighted Jaccard similarity.

Words are runs of letters, digits and their marks (Unicode's) of the
lower-cased text, and each character of a script written without blanks;
shingles are five words (a shorter text is one shingle). A shingle weighs ``tf * idf`` with
``idf = 1 + ln((N + 1) / (df + 1)) / ln(N + 1)``. Document frequencies are
counted over all documents, exactly and per shingle for shingles in two
documents or more and ``MIN_SHARE`` of them; all others weigh as much as one
that stands in a single document. The table that tasks share thus has at most
``1 / MIN_SHARE`` times the mean number of a text's shingles as entries,
however large the corpus; where texts are so long that these are more than
``MAX_SHARED``, only the most frequent ones are shared, and the others' weights
meet the texts by a join on the shingle. Each text gets ``BANDS * ROWS`` samples;
two texts share one with a probability equal to their weighted Jaccard
similarity, and become a candidate pair if all samples of a band agree.

Texts that are equal are one node from the start. Within a bucket of a band,

1. every node is compared with the node of the bucket that meets most others
   in all its buckets (a star around the likely original), so a bucket makes
   fewer pairs than it has nodes;
2. the texts of buckets that have three nodes or more and are not one class by
   then get ``FINE`` further samples. All pairs across classes are looked at in
   blocks, inside a join; those whose further samples let a similarity of
   ``THRESHOLD`` appear possible (``SPREAD`` standard deviations) are compared.

Pairs within one class are skipped, as they cannot change it. Compared means:
the weighted Jaccard similarity of the whole texts, at least ``THRESHOLD``.
Classes are the connected components of the links. Joins whose sides both grow
with the corpus are pinned to sort-merge, so that small inputs run as large
ones do.

Defined cases: a NULL text is a class of its own, as is a text without words
(equal ones are one class); repeated rows share a class; NULL ids are
allowed, a class's id is the least id in it. Extra columns are not read.
"""

from __future__ import annotations

import math
import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from selfmend.llm.common import map_arrow, materialised, mix64, run_hashes, runs, text_slices, utf8
from selfmend.llm.components import components

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 11, 4             # 1 - (1 - 0.8 ** 4) ** 11 = 0.997 of the pairs at 0.8 are candidates
SAMPLES = BANDS * ROWS
#: Shingles in fewer documents than this share weigh like those in one.
MIN_SHARE = 0.0005
#: At most so many shingles are in the table that tasks share (16 bytes each); the weights of others are joined to the texts.
MAX_SHARED = 1 << 22
#: Sums over hash buckets tell which shingles need no count.
COUNT_BITS = 20
#: Of weights given by hash bucket.
IDF_BITS = 16
FINE = 512
SPREAD = 3.0
#: Nodes of a bucket that meet in one block of step 2.
BLOCK = 256
#: Shingles sampled at a time.
STRETCH = 1 << 17
#: Shingles counted at a time, and counts handed on in a batch.
HELD_SHINGLES, HELD_ROWS = 1 << 21, 1 << 16
#: Column of the texts' weights that are not shared, where there are any.
JOINED = "__weights"
_MULTIPLIERS = mix64(np.arange(101, 101 + WORDS, dtype=np.uint64)) | np.uint64(1)
_SEEDS = mix64(np.arange(501, 501 + SAMPLES + FINE, dtype=np.uint64)) | np.uint64(1)
_WORD_BYTE = np.zeros(256, dtype=bool)
_WORD_BYTE[list(b"abcdefghijklmnopqrstuvwxyz0123456789")] = True
#: Scripts written without blanks between words: Thai, Lao, Myanmar, Khmer, Kana, ideographs.
_UNSPACED = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3005, 0x3007), (0x3040, 0x30FF), (0x31F0, 0x31FF),
             (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF))
_TABLE_BITS = 18


def _gamma_quantiles() -> np.ndarray:
    """Gamma(2, 1) at the midpoints of 2 ** 18 equal steps of probability."""
    p = (np.arange(1 << _TABLE_BITS) + 0.5) / (1 << _TABLE_BITS)
    low, high = np.zeros_like(p), np.full_like(p, 60.0)
    for _ in range(60):
        mid = (low + high) / 2
        below = -np.expm1(-mid) - mid * np.exp(-mid) < p
        low, high = np.where(below, mid, low), np.where(below, high, mid)
    return ((low + high) / 2).astype(np.float32)


_tables: list[np.ndarray] = []


def _variates() -> tuple[np.ndarray, np.ndarray]:
    if not _tables:
        r = _gamma_quantiles()
        _tables.extend([r, np.log(r)])
    return _tables[0], _tables[1]


_kinds: list[np.ndarray] = []


def _kind_of() -> np.ndarray:
    """By code point: 0 no part of a word, 1 part of one, 2 a word of its own."""
    if not _kinds:
        kind = np.fromiter((unicodedata.category(chr(i))[0] in "LNM" for i in range(0x110000)), dtype=np.uint8, count=0x110000)
        for a, b in _UNSPACED:
            kind[a:b + 1] *= 2
        _kinds.append(kind)
    return _kinds[0]


def word_spans(buf: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of each word of the texts, in order."""
    inside = _WORD_BYTE[buf]
    at = np.flatnonzero(buf >= 0xC0)            # the first bytes of characters beyond ASCII
    if not len(at):
        return runs(inside, edges)
    first, size = buf[at].astype(np.int64), 2 + (buf[at] >= 0xE0).astype(np.int64) + (buf[at] >= 0xF0)
    code = first & (0x7F >> size)
    for j in range(1, 4):
        more = size > j
        code[more] = code[more] << 6 | buf[at[more] + j] & 0x3F
    kind = _kind_of()[code]
    for j in range(4):
        part = (kind == 1) & (size > j)
        inside[at[part] + j] = True
    starts, ends = runs(inside, edges)
    alone = kind == 2
    if not alone.any():
        return starts, ends
    starts, ends = np.concatenate([starts, at[alone]]), np.concatenate([ends, at[alone] + size[alone]])
    order = np.argsort(starts, kind="stable")
    return starts[order], ends[order]


@dataclass(frozen=True)
class Shingles:
    """The distinct shingles (48-bit) of some texts, text after text."""
    ids: np.ndarray
    count: np.ndarray
    edges: np.ndarray       # of the texts, in ids


def shingles(column: pa.Array) -> Shingles:
    buf, edges = utf8(pc.utf8_lower(column))
    starts, ends = word_spans(buf, edges)
    words = run_hashes(buf, starts, ends)
    bounds = np.searchsorted(starts, edges)
    n_docs, n_words = len(edges) - 1, np.diff(bounds)
    doc = np.repeat(np.arange(n_docs, dtype=np.uint64), n_words)
    n = max(0, len(words) - WORDS + 1)
    mixed = np.zeros(n, dtype=np.uint64)
    for j in range(WORDS):
        mixed += words[j:j + n] * _MULTIPLIERS[j]
    whole = doc[:n] == doc[len(doc) - n:]
    keys = [doc[:n][whole] << np.uint64(48) | mix64(mixed[whole]) >> np.uint64(16)]
    short = np.flatnonzero((n_words > 0) & (n_words < WORDS))
    if len(short):
        own = np.array([int((words[a:b] * _MULTIPLIERS[:b - a]).sum(dtype=np.uint64)) ^ (b - a)
                        for a, b in zip(bounds[short].tolist(), bounds[short + 1].tolist())], dtype=np.uint64)
        keys.append(short.astype(np.uint64) << np.uint64(48) | mix64(own) >> np.uint64(16))
    key = np.sort(np.concatenate(keys))
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[:len(key)])
    count = np.diff(np.append(first, len(key)))
    key = key[first]
    at = np.searchsorted(key, np.arange(n_docs, dtype=np.uint64) << np.uint64(48))
    return Shingles(key & np.uint64((1 << 48) - 1), count, np.append(at, len(key)))


@dataclass(frozen=True)
class Idf:
    """The idf of the shingles ``ids`` (sorted), and of any other one."""
    ids: np.ndarray
    values: np.ndarray
    other: float

    def of(self, ids: np.ndarray) -> np.ndarray:
        if not len(self.ids):
            return np.full(len(ids), self.other)
        at = np.minimum(np.searchsorted(self.ids, ids), len(self.ids) - 1)
        return np.where(self.ids[at] == ids, self.values[at], self.other)


def _buckets(ids: np.ndarray, bits: int) -> np.ndarray:
    return (ids & np.uint64((1 << bits) - 1)).astype(np.int64)


def weights(s: Shingles, idf: Idf | np.ndarray, joined: pa.ListArray | None = None) -> np.ndarray:
    """``tf * idf``; an array holds the idf by the shingle's last ``IDF_BITS``
    bits. ``joined`` lists for each text shingles of it and their idf, which go first."""
    value = idf.of(s.ids) if isinstance(idf, Idf) else idf[_buckets(s.ids, IDF_BITS)]
    if joined is not None:
        def keys(ids, size):
            return np.repeat(np.arange(len(size), dtype=np.uint64), size) << np.uint64(48) | ids

        ids, own = (joined.flatten().field(x).to_numpy(zero_copy_only=False) for x in (0, 1))
        value[np.searchsorted(keys(s.ids, np.diff(s.edges)), keys(ids.astype(np.uint64), pc.list_value_length(joined).to_numpy()))] = own
    return s.count * value


def _joined(part: pa.RecordBatch, name: str = JOINED) -> pa.ListArray | None:
    return part.column(name) if name in part.schema.names else None


def inverse_frequencies(docs: DataFrame) -> Idf:
    """The idf of the shingles that tasks share."""
    return _frequencies(docs)[0]


def _frequencies(docs: DataFrame) -> tuple[Idf, DataFrame | None]:
    """The idf of shingles, from counts over all documents: first of hash
    buckets, then of each shingle of the buckets that reach the least count.
    A bucket's sum is never below the frequency of a shingle in it. What the
    shared table does not hold of them is a table ``id, idf``."""
    texts = docs.select("text").where("text IS NOT NULL")
    size = 1 << COUNT_BITS

    def count(batches):
        total = np.zeros(size, dtype=np.int64)
        n = 0
        for part in text_slices(batches):
            s = shingles(part.column("text"))
            total += np.bincount(_buckets(s.ids, COUNT_BITS), minlength=size)
            n += int((np.diff(s.edges) > 0).sum())
        yield framed(np.array([-1]), np.array([n]))
        at = np.flatnonzero(total)
        for i in range(0, len(at), HELD_ROWS):
            yield framed(at[i:i + HELD_ROWS], total[at[i:i + HELD_ROWS]])

    def framed(bucket, n):
        return pa.RecordBatch.from_pydict({"bucket": pa.array(bucket, pa.int32()), "n": pa.array(n, pa.int64())})

    sums = materialised(map_arrow(texts, count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")), "bucket-sums")
    n = sums.where("bucket < 0").agg(F.sum("n")).first()[0] or 0
    least = max(2, math.ceil(MIN_SHARE * n))
    full = np.zeros(size, dtype=bool)
    full[sums.where(f"bucket >= 0 AND n >= {least}").select("bucket").toPandas()["bucket"].to_numpy()] = True  # 2 ** COUNT_BITS at most
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(full))

    def count_each(batches):
        full = np.unpackbits(shared.value).astype(bool)
        held, n_held = [], 0
        for part in text_slices(batches):
            ids = shingles(part.column("text")).ids
            held.append(ids[full[_buckets(ids, COUNT_BITS)]])
            n_held += len(held[-1])
            if n_held >= HELD_SHINGLES:
                yield counted(held)
                held, n_held = [], 0
        if n_held:
            yield counted(held)

    def counted(held):
        ids, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_pydict({"id": pa.array(ids.astype(np.int64)), "n": pa.array(n, pa.int64())})

    counts = materialised(map_arrow(texts, count_each, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
                          .where(F.col("n") >= least), "shingle-counts")
    while counts.where(F.col("n") >= least).count() > MAX_SHARED:           # of very long texts, more than the mean ones allow for
        least *= 2
    found = counts.where(F.col("n") >= least).toPandas().sort_values("id")
    scale = max(math.log(n + 1), 1e-9)
    rest = counts.where(F.col("n") < least).select("id", (1 + F.log((n + 1) / (F.col("n") + 1)) / scale).alias("idf"))
    return Idf(found["id"].to_numpy().astype(np.uint64),
               1.0 + np.log((n + 1) / (found["n"].to_numpy().astype(np.float64) + 1)) / scale,
               1.0 + math.log((n + 1) / 2) / scale if n else 1.0), None if rest.isEmpty() else rest


def _with_weights(keyed: DataFrame, idf, rest: DataFrame | None) -> DataFrame:
    """``keyed`` with the idf of its texts' shingles that are in ``rest``."""
    if rest is None:
        return keyed

    def unshared(batches):
        for part in text_slices(batches):
            s = shingles(part.column("text"))
            own = ~np.isin(s.ids, idf.value.ids)
            owner = np.repeat(np.arange(part.num_rows), np.diff(s.edges))[own]
            yield pa.RecordBatch.from_arrays([part.column("__k").take(pa.array(owner)), pa.array(s.ids[own].astype(np.int64))],
                                             names=["__k", "id"])

    ids = map_arrow(keyed.select("__k", "text"), unshared, "__k binary, id long").distinct()
    found = ids.join(rest.hint("merge"), "id").groupBy("__k").agg(F.collect_list(F.struct("id", "idf")).alias(JOINED))
    out = keyed.join(materialised(found, "joined-weights").hint("merge"), "__k", "left")
    return out.withColumn(JOINED, F.coalesce(JOINED, F.array().cast("array<struct<id:bigint,idf:double>>")))


def samples(s: Shingles, weight: np.ndarray, which: range = range(SAMPLES)) -> np.ndarray:
    """The consistent weighted samples ``which`` of each text (64-bit), by
    ``ln a = ln c - r (t + 1 - beta)`` with ``t = floor(ln w / r + beta)``:
    the shingle of least ``a``, together with its ``t``."""
    table_r, table_ln_c = _variates()
    n_docs = len(s.edges) - 1
    best = np.full((len(which), n_docs), np.inf, dtype=np.float32)
    pick = np.zeros((len(which), n_docs), dtype=np.uint64)
    ln_w = np.log(weight).astype(np.float32)
    low = np.uint64((1 << _TABLE_BITS) - 1)
    for i in range(0, len(s.ids), STRETCH):
        ids, lw = s.ids[i:i + STRETCH], ln_w[i:i + STRETCH]
        inside = np.clip(s.edges, i, i + len(ids)) - i
        size = np.diff(inside)
        docs = np.flatnonzero(size)
        size, seg = size[docs], inside[:-1][docs]
        position = np.repeat(np.arange(len(docs)), size)
        for k, seed in enumerate(_SEEDS[which.start:which.stop]):
            x = (ids + seed) * np.uint64(0x9FB21C651E98DF25)
            x ^= x >> np.uint64(31)
            x *= seed
            x ^= x >> np.uint64(29)
            r = table_r[x >> np.uint64(64 - _TABLE_BITS)]
            ln_c = table_ln_c[x >> np.uint64(64 - 2 * _TABLE_BITS) & low]
            beta = (x & np.uint64((1 << 24) - 1)).astype(np.float32) * np.float32(2.0 ** -24)
            t = np.floor(lw / r + beta)
            ln_a = ln_c - r * (t + np.float32(1) - beta)
            least = np.minimum.reduceat(ln_a, seg)
            hits = np.flatnonzero(ln_a == least[position])
            owner = position[hits]
            hits = hits[np.concatenate([[True], owner[1:] != owner[:-1]])]
            better = least < best[k, docs]
            own = docs[better]
            best[k, own] = least[better]
            pick[k, own] = mix64(ids[hits[better]] * np.uint64(0xD1342543DE82EF95) + t[hits[better]].astype(np.int64).astype(np.uint64))
    return pick.T


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Of two sets of sorted shingles with their weights."""
    if len(a[0]) > len(b[0]):
        a, b = b, a
    if not len(a[0]):
        return 0.0
    at = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    both = b[0][at] == a[0]
    shared = float(np.minimum(a[1][both], b[1][at[both]]).sum())
    return shared / (float(a[1].sum()) + float(b[1].sum()) - shared)


def band_hashes(pick: np.ndarray) -> np.ndarray:
    """The hash of each band of samples; different bands never agree but by chance."""
    bands = np.zeros((len(pick), BANDS), dtype=np.uint64)
    for j in range(ROWS):
        bands += pick[:, j:SAMPLES:ROWS] * _SEEDS[j]
    return mix64(bands + _SEEDS[:BANDS]).astype(np.int64)


def _lists(values: np.ndarray) -> pa.ListArray:
    n, m = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * m, pa.int32()), pa.array(values.ravel()))


def _extra(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c == JOINED]


def _signatures(rows: DataFrame, idf) -> DataFrame:
    """``__k, doc_id, bands`` of each row whose text has a word."""
    def sign(batches):
        for part in text_slices(batches):
            s = shingles(part.column("text"))
            full = np.diff(s.edges) > 0
            bands = band_hashes(samples(s, weights(s, idf.value, _joined(part))))[full]
            own = pa.array(full)
            yield pa.RecordBatch.from_arrays([part.column("__k").filter(own), part.column("doc_id").filter(own), _lists(bands)],
                                             names=["__k", "doc_id", "bands"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_arrow(rows.select("__k", "doc_id", "text", *_extra(rows)), sign, f"__k binary, doc_id {kind}, bands array<bigint>")


def _fine_samples(texts: DataFrame, idf) -> DataFrame:
    """``__k, sample``: 32 bits of each of the ``FINE`` further samples."""
    def sign(batches):
        for part in text_slices(batches):
            s = shingles(part.column("text"))
            pick = samples(s, weights(s, idf.value, _joined(part)), range(SAMPLES, SAMPLES + FINE))
            yield pa.RecordBatch.from_arrays([part.column("__k"), _lists((pick >> np.uint64(32)).astype(np.uint32).view(np.int32))],
                                             names=["__k", "sample"])

    return map_arrow(texts.select("__k", "text", *_extra(texts)), sign, "__k binary, sample array<int>")


def _verified(pairs: DataFrame, texts: DataFrame, idf) -> DataFrame:
    """The pairs ``(a, b)`` whose texts are similar enough."""
    def compare(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                sets = []
                for x in ("a", "b"):
                    column = part.column(f"text_{x}").dictionary_encode()       # a star's centre is read once
                    s = shingles(column.dictionary)
                    joined = _joined(part, JOINED + x)
                    first = pa.array(np.unique(column.indices.to_numpy(), return_index=True)[1])
                    w = weights(s, idf.value, None if joined is None else joined.take(first))
                    own = [(s.ids[x:y], w[x:y]) for x, y in zip(s.edges[:-1], s.edges[1:])]
                    sets.append([own[j] for j in column.indices.to_pylist()])
                alike = [weighted_jaccard(x, y) >= THRESHOLD - 1e-12 for x, y in zip(*sets)]
                yield part.select(["a", "b"]).filter(pa.array(alike))

    own = lambda x: texts.select(F.col("__k").alias(x), F.col("text").alias(f"text_{x}"),
                                 *[F.col(c).alias(c + x) for c in _extra(texts)])
    joined = pairs.hint("merge").join(own("b"), "b").hint("merge").join(own("a"), "a")
    found = map_arrow(joined, compare, "a binary, b binary")
    return materialised(found, "links")


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows with a text, and the text's digest as ``__k``."""
    return docs.where(F.col("text").isNotNull()).withColumn("__k", F.unhex(F.md5(F.col("text").cast("binary"))))


@dataclass(frozen=True)
class Classes:
    rows: DataFrame         # __k, doc_id of every row with a text
    nodes: DataFrame        # __k, root, doc_id: of each distinct text its class and least id


def classes(docs: DataFrame) -> Classes:
    """The classes of near duplicates among the texts of ``docs``."""
    keyed = _keyed(docs.select("doc_id", "text"))
    shared, rest = _frequencies(docs)
    idf = docs.sparkSession.sparkContext.broadcast(shared)
    rows = materialised(keyed.select("__k", "doc_id"), "rows")
    first = materialised(rows.groupBy("__k").agg(F.min("doc_id").alias("doc_id")), "nodes")

    # buckets with more than one text
    weighed = _with_weights(keyed, idf, rest)
    signed = materialised(_signatures(weighed, idf), "signatures")
    member = signed.select("__k", F.explode("bands").alias("h"), F.xxhash64("__k").alias("o"))
    buckets = materialised(member.groupBy("h").agg(F.min("o").alias("least"), F.max("o").alias("most"))
                           .where("least != most"), "buckets")
    shared = materialised(member.join(buckets.select("h").hint("merge"), "h").select("h", "__k").distinct(), "shared")
    needed = materialised(shared.select("__k").distinct().join(first.hint("merge"), "__k"), "needed")
    own = (keyed["__k"] == needed["__k"]) & keyed["doc_id"].eqNullSafe(needed["doc_id"])
    texts = keyed.join(needed.hint("merge"), own, "left_semi").select("__k", "text").dropDuplicates(["__k"])
    texts = materialised(_with_weights(texts, idf, rest), "texts")

    # 1: a star in every bucket
    sized = materialised(shared.groupBy("h").agg(F.count("*").alias("n")), "sizes")
    met = materialised(shared.join(sized.hint("merge"), "h").groupBy("__k").agg(F.sum("n").alias("met")), "met")
    centre = (shared.join(met.hint("merge"), "__k").groupBy("h").agg(F.max(F.struct("met", "__k")).alias("c"))
              .select("h", F.col("c.__k").alias("centre")))
    star = shared.join(materialised(centre, "centres").hint("merge"), "h").where("__k != centre")
    star = materialised(star.select(F.least("__k", "centre").alias("a"), F.greatest("__k", "centre").alias("b"))
                        .distinct(), "pairs")
    links = _verified(star, texts, idf)
    found = components(links)

    # 2: across classes, in buckets of three and more that hold several
    placed = shared.join(found.hint("merge"), F.col("__k") == F.col("node"), "left") \
        .select("h", "__k", F.coalesce("root", "__k").alias("root"))
    placed = materialised(placed, "placed")
    of_class = F.xxhash64("root")
    mixed = materialised(placed.groupBy("h").agg(F.min(of_class).alias("c0"), F.max(of_class).alias("c1"),
                                                 F.count("*").alias("n")).where("c0 != c1 AND n > 2").select("h", "n"), "mixed")
    open_ = materialised(placed.join(mixed.hint("merge"), "h"), "open")
    spots = materialised(open_.groupBy("__k").agg(F.sort_array(F.collect_set("h")).alias("spots")), "spots")
    fine = materialised(_fine_samples(texts.join(spots.hint("merge"), "__k", "left_semi"), idf), "fine")
    open_ = open_.join(spots.hint("merge"), "__k").join(fine.hint("merge"), "__k").withColumn("blocks", F.expr(f"cast(ceil(n / {BLOCK}) as int)")) \
        .withColumn("own", F.expr("cast(pmod(xxhash64(__k), blocks) as int)"))
    open_ = materialised(open_, "open")
    left = open_.select("h", F.col("__k").alias("a"), F.col("root").alias("root_a"),
                        F.col("sample").alias("sample_a"), F.col("spots").alias("spots_a"), F.col("own").alias("i"),
                        F.explode(F.expr("sequence(0, blocks - 1)")).alias("j"))
    right = open_.select("h", F.col("__k").alias("b"), F.col("root").alias("root_b"),
                         F.col("sample").alias("sample_b"), F.col("spots").alias("spots_b"), F.col("own").alias("j"),
                         F.explode(F.expr("sequence(0, blocks - 1)")).alias("i"))
    least = math.floor(FINE * THRESHOLD - SPREAD * math.sqrt(FINE * THRESHOLD * (1 - THRESHOLD)))
    agree = F.expr(f"size(filter(zip_with(sample_a, sample_b, (x, y) -> x = y), z -> z)) >= {least}")
    once = F.col("h") == F.get(F.array_intersect("spots_a", "spots_b"), F.lit(0))     # in the first bucket they share
    across = left.join(right.hint("merge"), ["h", "i", "j"]) \
        .where((F.col("a") < F.col("b")) & (F.col("root_a") != F.col("root_b")) & once & agree).select("a", "b")
    across = materialised(across.join(star.hint("merge"), ["a", "b"], "left_anti"), "pairs")
    more = _verified(across, texts, idf)
    if not more.isEmpty():
        found = components(links.unionByName(more))
    nodes = first.join(found.hint("merge"), F.col("__k") == F.col("node"), "left") \
        .select("__k", F.coalesce("root", "__k").alias("root"), "doc_id")
    return Classes(rows, materialised(nodes, "classes"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``doc_id`` and ``class_id``, the least id of its class."""
    found = classes(docs)
    least = found.nodes.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    by_text = materialised(found.nodes.join(least.hint("merge"), "root").select("__k", "class_id"), "class-ids")
    alone = docs.where(F.col("text").isNull()).select("doc_id", F.col("doc_id").alias("class_id"))
    return found.rows.join(by_text.hint("merge"), "__k").select("doc_id", "class_id").unionByName(alone)


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class, the one of least id; rows without
    a text stay. Columns unchanged."""
    names = docs.columns
    found = classes(docs)
    kept = found.nodes.groupBy("root").agg(F.min(F.struct("doc_id", "__k")).alias("s")).select("s.doc_id", "s.__k")
    kept = materialised(kept.select(F.col("__k").alias("__kept"), F.col("doc_id").alias("__id")), "kept")
    keyed = _keyed(docs)
    own = (F.col("__k") == F.col("__kept")) & F.col("doc_id").eqNullSafe(F.col("__id"))
    rows = keyed.join(kept.hint("merge"), own, "left_semi").dropDuplicates(["__k", "doc_id"]).select(*names)
    return rows.unionByName(docs.where(F.col("text").isNull()))

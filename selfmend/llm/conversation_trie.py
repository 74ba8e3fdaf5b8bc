"""The prefix trie of conversations, by union-find over sorted-neighbour LCPs.

A conversation is a sequence of turns; each distinct sequence of first ``d``
turns that some conversation starts with is a node of depth ``d``. Shared
prefixes need to be processed once only, which ``saved_tokens`` adds up.

A turn becomes 20 bytes: the MD5 of role and text, and the text's length. The
turns' bytes in a row are a conversation's key; texts are left behind. Equal
keys are one sequence from the start (a partial aggregate). Then

1. keys are range-partitioned and sorted, and the longest common prefix (LCP)
   of each two neighbours is an edge of that depth;
2. in each partition the edges are taken in descending depth by a union-find.
   A component is a run of neighbours with a common prefix, its node; a merge
   at depth ``d`` makes the node that branches there. A node that is no prefix
   of the partition's first or last key is complete and written;
3. what is left of a partition, its contracted forest, are two keys, the first
   and the last, and for the nodes along them what already hangs there. ``FAN``
   neighbouring forests at a time are merged by the same union-find, round by
   round, until one is left, which closes the root.

Nodes written before their parent was complete name it by the digest of its
prefix and are joined with it at the end. The conversations that end at a node
are hashed apart: sorted by (sequence, id) over all partitions, joined into
pieces there, and the pieces of a sequence are read in order by one SHA-256.

Defined cases: turns are ordered by ``turn`` (NULL first), ties by the digest
of role and text; a NULL role or text is empty; rows without a conv_id take no
part; repeated rows are repeated turns. A sequence without turns ends at the
root. Without any conversation there is no node. The digests of one
conversation (20 bytes a turn) must fit into a row. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import json
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from selfmend.llm.common import map_arrow, materialised

#: Bytes of a turn in a key: a digest and the text's length.
TURN = 20
#: Forests that are merged at a time.
FAN = 32
#: About so many turns are sorted in a partition.
PART_TURNS = 200_000
#: Conversation ids joined into one piece.
PIECE = 1 << 16
_NONE = (1 << 63) - 1
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def sequences(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns``: per conversation its turns in order, each a digest
    of role and text and the text's length, in 40 hex digits."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    symbol = F.concat(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")),
                      F.lpad(F.hex(F.length(text)), 8, "0"))
    return (conversations.where("conv_id IS NOT NULL")
            .groupBy(F.col("conv_id").cast("long").alias("conv_id"))
            .agg(F.sort_array(F.collect_list(F.struct("turn", symbol.alias("symbol")))).alias("t"))
            .select("conv_id", F.col("t.symbol").alias("turns")))


def with_shared_heads(conversations: DataFrame, every: int, head: Column, longest: int) -> DataFrame:
    """``conv_id, turns`` where the first ``head`` turns (an expression over
    ``conv_id``, ``longest`` at most) are those of the conversation whose id is
    the next lower multiple of ``every`` (fewer if it has fewer), and the own
    turns follow after the first ``head``."""
    first = conversations.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, longest).alias("shared"))
    joined = (conversations.withColumn("base", F.col("conv_id") - F.col("conv_id") % every)
              .join(first.hint("merge"), "base", "left").withColumn("n", head.cast("int")))
    shared = F.slice(F.coalesce("shared", F.array().cast("array<string>")), F.lit(1), F.col("n"))
    own = F.slice("turns", F.col("n") + 1, F.size("turns"))
    return joined.select("conv_id", F.concat(shared, own).alias("turns"))


# ------------------------------------------------------------------ the forest
class Node:
    """What is known of a node: its members, their least id, children, leaves
    below, what its subtree saves without itself, the least id that ends here,
    and written rows that wait for the node's id."""
    __slots__ = ("n", "low", "children", "leaves", "saved", "own", "waiting")

    def __init__(self, n=0, low=_NONE, children=0, leaves=0, saved=0, own=None):
        self.n, self.low, self.children, self.leaves, self.saved, self.own = n, low, children, leaves, saved, own
        self.waiting: list[list] = []

    def add(self, other: Node) -> None:
        self.n += other.n
        self.low = min(self.low, other.low)
        self.children += other.children
        self.leaves += other.leaves
        self.saved += other.saved
        self.own = other.own if self.own is None else self.own
        if len(self.waiting) < len(other.waiting):
            self.waiting, other.waiting = other.waiting, self.waiting
        self.waiting += other.waiting

    def values(self) -> list:
        return [self.n, self.low, self.children, self.leaves, self.saved, self.own]


#: A key, and by depth what hangs at the nodes along it.
Spine = tuple[bytes, dict[int, Node]]


def lcp(a: bytes, b: bytes) -> int:
    """The turns that two keys have in common at their start."""
    low, high = 0, min(len(a), len(b)) // TURN
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[:mid * TURN] == b[:mid * TURN] else (low, mid - 1)
    return low


def _digest(key: bytes, depth: int) -> bytes:
    return hashlib.md5(key[:depth * TURN]).digest()


def _turn_length(key: bytes, depth: int) -> int:
    return int.from_bytes(key[depth * TURN - 4:depth * TURN], "big") if depth else 0


def grow(spines: list[Spine], closing: bool, named: bool) -> tuple[list[list], list[Spine]]:
    """The nodes complete within the sorted ``spines``, as rows ``conv_id,
    depth, parent, parent's digest, n_convs, n_children, n_leaves, saved, own,
    digest`` (the last if ``named``), and the contracted forest: the first and
    the last key with what hangs along them. With ``closing`` all are complete."""
    keys, m = [k for k, _ in spines], len(spines)
    edges, hung = defaultdict(list), defaultdict(list)
    for i in range(m - 1):
        edges[lcp(keys[i], keys[i + 1])].append(i)
    for i, (_, along) in enumerate(spines):
        for depth, node in along.items():
            hung[depth].append((i, node))
    up, left, right = list(range(m)), list(range(m)), list(range(m))
    node: list[Node | None] = [None] * m
    top = [0] * m
    rows: list[list] = []
    left_over: tuple[dict, dict] = ({}, {})

    def find(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def leave(r: int) -> None:
        """The node of an open component stays with its spine."""
        own, depth = node[r], top[r]
        if own.waiting:
            digest = _digest(keys[left[r]], depth)
            for row in own.waiting:
                row[3] = digest
            own.waiting = []
        if own.n:
            left_over[left[r] != 0][depth] = own

    def write(r: int, depth: int) -> Node:
        """The component's node and the unbranched ones above it down to below
        ``depth`` are complete; what hangs at ``depth`` because of them."""
        own, key = node[r], keys[left[r]]
        leaves = own.leaves if own.children else 1
        children, ends, saved, row = own.children, own.own, own.saved, None
        for d in range(top[r], depth, -1):
            saved += (own.n - 1) * _turn_length(key, d)
            new = [own.low, d, None, None, own.n, children, leaves, saved, ends, _digest(key, d) if named else None]
            if row is not None:
                row[2] = own.low
            rows.append(new)
            row, children, ends = new, 1, None
        for waiting in own.waiting:
            waiting[2] = own.low
        out = Node(own.n, own.low, 1, leaves, saved)
        out.waiting.append(row)
        return out

    def reach(i: int, depth: int) -> int:
        """The component of ``i``, with its node at ``depth``."""
        r = find(i)
        if node[r] is None:
            node[r] = Node()
        elif top[r] > depth:
            if not closing and (left[r] == 0 or right[r] == m - 1):
                leave(r)
                node[r] = Node()
            else:
                node[r] = write(r, depth)
        top[r] = depth
        return r

    for depth in sorted({*edges, *hung}, reverse=True):
        for i in edges[depth]:
            a, b = reach(i, depth), reach(i + 1, depth)
            node[a].add(node[b])
            up[b], right[a], node[b] = a, right[b], None
        for i, own in hung[depth]:
            node[reach(i, depth)].add(own)
    if not m:
        return rows, []
    if closing:
        write(find(0), -1)
        return rows, []
    for i in {find(0), find(m - 1)}:
        leave(i)
    return rows, [(keys[0], left_over[0]), (keys[-1], left_over[1])][:m]


_ROWS = ("conv_id long, depth long, parent_conv_id long, parent_key binary, n_convs long, n_children long, "
         "n_leaves long, saved_tokens long, own long, node_key binary")
_SCHEMA = f"{_ROWS}, part long, side int, key binary, along string"
_NAMES = [x.split()[0] for x in _SCHEMA.split(", ")]
_TYPES = {"long": pa.int64(), "binary": pa.binary(), "int": pa.int32(), "string": pa.string()}
_ARROW = [_TYPES[x.split()[1]] for x in _SCHEMA.split(", ")]


def _batch(rows: list[list], part: int, spines: list[Spine]) -> pa.RecordBatch:
    table = [[*row, None, None, None, None] for row in rows]
    for side, (key, along) in enumerate(spines):
        table.append([None] * 10 + [part, side, key, json.dumps([[d, *x.values()] for d, x in along.items()])])
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in table], t) for i, t in enumerate(_ARROW)], names=_NAMES)


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The forest of a partition's sorted sequences ``key, own, n, part``."""
    spines, part = [], 0
    for b in batches:
        for key, own, n, part in zip(*[b.column(c).to_pylist() for c in ("key", "own", "n", "part")]):
            spines.append((key, {len(key) // TURN: Node(n, own, own=own)}))
    if spines:
        yield _batch(*_and_part(grow(spines, False, False), part))


def _and_part(grown, part):
    rows, spines = grown
    return rows, part, spines


def _merged(closing: bool):
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Groups of forests, sorted by ``group, part, side``."""
        spines, at = [], None
        for b in batches:
            for group, key, along in zip(*[b.column(c).to_pylist() for c in ("group", "key", "along")]):
                if group != at and spines:
                    yield _batch(*_and_part(grow(spines, closing, True), at))
                    spines = []
                at = group
                spines.append((key, {d: Node(*x) for d, *x in json.loads(along)}))
        if spines:
            yield _batch(*_and_part(grow(spines, closing, True), at))
    return merge


# ----------------------------------------------------------------- who ends where
def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of sorted ``k, conv_id``: ``k, first, ids``, the ids joined."""
    k, ids, out, size = None, [], [], 0

    def framed():
        types = (pa.binary(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=["k", "first", "ids"])

    for b in batches:
        for key, conv in zip(b.column("k").to_pylist(), b.column("conv_id").to_pylist()):
            if ids and (key != k or len(ids) == PIECE):
                out.append((k, ids[0], ",".join(map(str, ids))))
                size += len(ids)
                ids = []
                if size >= PIECE:
                    yield framed()
                    out, size = [], 0
            k = key
            ids.append(conv)
    if ids:
        out.append((k, ids[0], ",".join(map(str, ids))))
    if out:
        yield framed()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted ``k, first, ids``: ``own, ends_sha256`` per ``k``."""
    k, own, sha = None, None, None
    for b in batches:
        found = []
        for key, first, ids in zip(*[b.column(c).to_pylist() for c in ("k", "first", "ids")]):
            if sha is not None and key == k:
                sha.update(b"," + ids.encode())
                continue
            if sha is not None:
                found.append((own, sha.hexdigest()))
            k, own, sha = key, first, hashlib.sha256(ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in found], pa.int64()), pa.array([r[1] for r in found], pa.string())],
                                         names=["own", "ends_sha256"])
    if sha is not None:
        yield pa.RecordBatch.from_arrays([pa.array([own], pa.int64()), pa.array([sha.hexdigest()])], names=["own", "ends_sha256"])


def _ends(keyed: DataFrame, parts: int) -> DataFrame:
    """``own, ends_sha256``: per sequence its least conv_id, and the digest of all."""
    slim = materialised(keyed.select(F.unhex(F.md5("key")).alias("k"), "conv_id"), "ends")
    ranged = slim.repartitionByRange(parts, "k", "conv_id").sortWithinPartitions("k", "conv_id")
    pieces = map_arrow(ranged, _pieces, "k binary, first long, ids string")
    return map_arrow(pieces.repartition("k").sortWithinPartitions("k", "first"), _hashed, "own long, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """Per node of the trie of ``conv_id, turns`` (of ``sequences``): ``conv_id``
    (its smallest member), ``depth``, ``parent_conv_id`` (its parent's),
    ``n_convs, n_children, n_leaves, saved_tokens, ends_sha256``."""
    spark = conversations.sparkSession
    keyed = materialised(conversations.select("conv_id", F.unhex(F.array_join("turns", "")).alias("key")), "keys")
    distinct = materialised(keyed.groupBy("key").agg(F.min("conv_id").alias("own"), F.count("*").alias("n")), "sequences")
    turns, rows = distinct.agg(F.sum(F.length("key")), F.sum("n")).first()
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, -(-(turns or 0) // (TURN * PART_TURNS)))
    ranged = distinct.repartitionByRange(parts, "key").sortWithinPartitions("key").withColumn(
        "part", F.spark_partition_id().cast("long"))
    step = materialised(map_arrow(ranged, _local, _SCHEMA), "forest")
    nodes = step.where("key IS NULL")
    while True:
        spines = step.where("key IS NOT NULL").withColumn("group", F.floor(F.col("part") / FAN))
        left = spines.select("part").distinct().count()
        if not left:
            break
        if left <= FAN:
            spines = spines.withColumn("group", F.lit(0).cast("long"))
        sorted_ = spines.select("group", "part", "side", "key", "along").repartition("group").sortWithinPartitions("group", "part", "side")
        step = materialised(map_arrow(sorted_, _merged(left <= FAN), _SCHEMA), "forest")
        nodes = nodes.unionByName(step.where("key IS NULL"))
        if left <= FAN:
            break
    parents = nodes.where("node_key IS NOT NULL").select(F.col("node_key").alias("parent_key"), F.col("conv_id").alias("found"))
    late = (nodes.where("parent_key IS NOT NULL").join(parents.hint("merge"), "parent_key")
            .withColumn("parent_conv_id", F.col("found")).drop("found"))
    whole = nodes.where("parent_key IS NULL").unionByName(late.select(*nodes.columns))
    ends = _ends(keyed, max(least, -(-(rows or 0) // PART_TURNS)))
    return (whole.join(ends.hint("merge"), "own", "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(_NO_ENDS)).alias("ends_sha256")))


def last_turns(nodes: DataFrame, sequences_: DataFrame, conversations: DataFrame) -> DataFrame:
    """``conv_id, depth, role, text``: the last turn of each node but the root."""
    at = (nodes.where("depth > 0").select("conv_id", "depth").join(sequences_.hint("merge"), "conv_id")
          .select("conv_id", "depth", F.element_at("turns", F.col("depth").cast("int")).alias("symbol")))
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    symbol = F.concat(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")),
                      F.lpad(F.hex(F.length(text)), 8, "0"))
    texts = conversations.select(symbol.alias("symbol"), role.alias("role"), text.alias("text")).dropDuplicates(["symbol"])
    return at.join(texts.hint("merge"), "symbol").select("conv_id", "depth", "role", "text")


#: The same result in SQL: all prefixes as lists. CRC-32 by its bits.
ORACLE = """
WITH ids AS (SELECT conv_id, (list_reduce(list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
                 lambda c, x: list_reduce(list_concat([xor(c, x)], [0, 0, 0, 0, 0, 0, 0, 0]),
                     lambda r, z: xor(r // 2, CASE WHEN r % 2 = 1 THEN 3988292384 ELSE 0 END)))) AS crc0
             FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)),
heads AS (SELECT conv_id, xor(CAST(crc0 AS BIGINT), 4294967295) % 6 AS h FROM ids),
o AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id
        ORDER BY turn NULLS FIRST, md5(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, '')))) AS k
      FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT h.conv_id, o.k, o.role, o.text FROM heads h JOIN o ON o.conv_id = h.conv_id - h.conv_id % 100 AND o.k <= h.h
        UNION ALL SELECT h.conv_id, o.k, o.role, o.text FROM heads h JOIN o ON o.conv_id = h.conv_id AND o.k > h.h),
pre AS (SELECT conv_id, row_number() OVER w AS d, list(struct_pack(r := role, t := text)) OVER w AS p, length(text) AS n
        FROM own WINDOW w AS (PARTITION BY conv_id ORDER BY k)),
members AS (SELECT conv_id, d, p, n FROM pre UNION ALL SELECT conv_id, 0, [], 0 FROM heads),
size AS (SELECT conv_id, max(d) AS size FROM members GROUP BY conv_id),
nodes AS (SELECT p, d, min(conv_id) AS conv_id, count(*) AS n, max(n) AS len,
                 coalesce(string_agg(CASE WHEN d = size THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '') AS ends
          FROM members JOIN size USING (conv_id) GROUP BY p, d),
kids AS (SELECT p[1:d - 1] AS p, d - 1 AS d, count(*) AS kids FROM nodes WHERE d > 0 GROUP BY ALL),
full_ AS (SELECT n.*, coalesce(kids, 0) AS kids FROM nodes n LEFT JOIN kids k ON k.p = n.p AND k.d = n.d),
above AS (SELECT p, d, n, len, kids, unnest(range(0, d + 1)) AS a FROM full_),
below AS (SELECT p[1:a] AS p, a AS d, sum(CASE WHEN kids = 0 THEN 1 ELSE 0 END) AS leaves, sum((n - 1) * len) AS saved FROM above GROUP BY ALL)
SELECT f.conv_id, CAST(f.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, f.n AS n_convs, f.kids AS n_children,
       CAST(b.leaves AS BIGINT) AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, sha256(f.ends) AS ends_sha256
FROM full_ f JOIN below b ON b.p = f.p AND b.d = f.d LEFT JOIN nodes u ON f.d > 0 AND u.d = f.d - 1 AND u.p = f.p[1:f.d - 1]
"""

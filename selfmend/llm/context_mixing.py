"""LM scoring by online logistic context mixing.

A text is a sequence of tokens, its words lower-cased (A-Z) and one end. Each
token becomes binary decisions: the path of a Huffman code over the endings
(last two bytes) of the frequent tokens, the end and an escape, and from an
ending on the path of a code over the frequent tokens that have it; an
escaped token is spelled, byte by byte, each byte a path of the code of the
byte before. A decision has ``K`` predictors, the zeros and ones counted over
all training texts in

* the token code: the decision alone (known from the tokens' counts); it after
  the ending of the token before; it after the last of the ``LEADS`` most
  frequent tokens;
* a spelling: the decision alone; it after that token and two bytes; it after
  four bytes of the word so far,

the contexts hashed into ``2 ** SLOT_BITS`` slots. The stretched predictions
``ln p / (1 - p)`` are combined by weights into one (logistic mixing); the
weights are chosen by a gate, the kind of decision and how many of its hashed
contexts were seen. A text starts with the same weights everywhere and learns
its own online, by a gradient step after each ``BLOCK`` of tokens; a map from
mixed to observed probabilities, learnt likewise, refines the result. The decisions' costs add up to the text's bits, and so to its
log10 probability and its bits per byte.

Corpus work, all of it over all training texts:

1. counts of tokens and bytes: partial sums per task, added up by key. At most
   ``1 / FREQUENT_SHARE`` tokens reach ``FREQUENT_SHARE`` of the tokens; only
   they (and the code) are collected and shared with tasks;
2. counts per slot: each task counts equal pairs of context and symbol, ``HELD``
   symbols at a time, adds up the slots of the different ones and hands on those
   that occurred; they are added up slot block by slot block. The table that tasks
   share has ``2 ** SLOT_BITS`` predictions of 2 bytes, whatever the corpus;
3. one scan scores the texts. Exact counts of the other tokens, which grow
   with the corpus, meet the texts by a join on the token.

Defined cases: a NULL or empty text is one end; repeated rows are scored (and
learnt from) once per row; without training texts nothing is known and the
base score is 0. Tokens are told apart by a 48-bit hash and their ending. A text of any length
is scored whole, ``SEGMENT`` tokens at a time; its token offsets (about ten
bytes a byte of text) must fit into a task. Extra columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from selfmend.llm.common import map_arrow, materialised, mix64, run_hashes, runs, text_slices, utf8

SLICE = 800_000
#: Tokens of a text that are worked on at a time, and after which weights move.
SEGMENT, BLOCK = 1 << 15, 64
#: Tokens whose decisions are looked up together, or a block of each text.
TOGETHER = 1 << 13
FREQUENT_SHARE = 2.0 ** -20
K = 3
#: The most frequent tokens, whose last one before a token is a context.
LEADS = 64
SLOT_BITS = 22
#: Slots whose counts travel together.
PART_BITS = 14
#: Tokens, or symbols, counted at a time.
HELD = 1 << 21
#: Added to the counts of zeros and ones.
PRIOR = 0.4
UNIT = 1.0 / 1024
#: First weights, in the token code and in spellings, by how many hashed contexts were seen.
GATES = K
WEIGHTS = (np.array([[1.0, 0.0, 0.0], [0.6, 0.5, 0.5], [0.3, 0.4, 0.4]], dtype=np.float32),
           np.array([[1.0, 0.0, 0.0], [0.5, 0.6, 0.6], [0.2, 0.4, 0.5]], dtype=np.float32))
RATE = 0.02
#: Buckets of the refining map, two to a unit of the stretched prediction.
BUCKETS = 33
MAP_RATE = 0.02
FLOOR = 1.0 / 65536
_MOST, _TWO = np.array([-16, 16], np.float32), np.float32(2)
_BUCKET, _SURE = np.array([-(BUCKETS // 2), BUCKETS // 2], np.float32), np.array([FLOOR, 1 - FLOOR], np.float32)
END = np.uint64(0)
_START = np.uint64(1)
_ENDING = np.uint64(0xFFFF)
_WORD_END = 0x20
_WORD = np.ones(256, dtype=bool)
_WORD[[0x20, *range(0x09, 0x0E)]] = False
_ODD = mix64(np.arange(9001, 9001 + 4 * K, dtype=np.uint64)) | np.uint64(1)
_ODD32 = _ODD.astype(np.uint32) | np.uint32(1)


def base_learns(doc_id: Column) -> Column:
    """Rows that are learnt from: ``crc32(doc_id as text) mod 7`` is not 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 != 2, F.lit(True))


# ---------------------------------------------------------------------- tokens
@dataclass(frozen=True)
class Tokens:
    """The tokens of some texts, text after text, an end after each text."""
    buf: np.ndarray         # lower-cased bytes of the texts
    start: np.ndarray       # of each token in buf; an end has no bytes
    end: np.ndarray
    hash: np.ndarray        # its last 16 bits are the token's last two bytes
    doc: np.ndarray
    edges: np.ndarray       # of the texts, in tokens


def tokens(column: pa.Array) -> Tokens:
    raw, edges = utf8(column)
    buf = raw + (raw - np.uint8(0x41) < np.uint8(26)) * np.uint8(0x20)
    starts, ends = runs((buf != np.uint8(0x20)) & (buf - np.uint8(0x09) > np.uint8(4)), edges)
    bounds = np.searchsorted(starts, edges)
    n_docs = len(edges) - 1
    n_words = np.diff(bounds)
    doc = np.repeat(np.arange(n_docs), n_words + 1)
    out_edges = np.concatenate([[0], np.cumsum(n_words + 1)])
    word = np.arange(len(starts)) + np.repeat(np.arange(n_docs), n_words)       # an end after each text before
    hashes = np.zeros(len(doc), dtype=np.uint64)
    start, end = np.zeros(len(doc), dtype=np.int64), np.zeros(len(doc), dtype=np.int64)
    ending = buf[ends - 1].astype(np.uint64) | np.where(ends - starts > 1, buf[ends - 2], 0).astype(np.uint64) << np.uint64(8)
    hashes[word] = run_hashes(buf, starts, ends) & ~_ENDING | ending
    start[word], end[word] = starts, ends
    return Tokens(buf, start, end, hashes, doc, out_edges)


# ------------------------------------------------------------------------ codes
@dataclass(frozen=True)
class Code:
    """A binary prefix code: of each symbol the decisions of its path, each
    with its bit, a hash of it, and its stretched prediction by the counts."""
    at: np.ndarray
    size: np.ndarray
    bit: np.ndarray
    node: np.ndarray
    alone: np.ndarray


def huffman(counts: list[int], family: int) -> Code:
    """By counts; ties to smaller symbols, inner nodes last."""
    heap = [(c, i) for i, c in enumerate(counts)]
    heapq.heapify(heap)
    n = len(counts)
    above, bit, alone = [0] * (2 * n - 1), [0] * (2 * n - 1), [0.0] * n
    top = n
    while len(heap) > 1:
        (a, i), (b, j) = heapq.heappop(heap), heapq.heappop(heap)
        above[i], above[j], bit[j] = top, top, 1
        alone[top - n] = math.log(b / a)
        heapq.heappush(heap, (a + b, top))
        top += 1
    size, nodes, bits = [], [], []
    for i in range(n):
        path = []
        while i != top - 1:
            path.append((above[i] - n, bit[i]))
            i = above[i]
        size.append(len(path))
        nodes += [x for x, _ in reversed(path)]
        bits += [x for _, x in reversed(path)]
    nodes, size = np.array(nodes, np.int64), np.array(size, np.int64)
    hashed = mix64(nodes.astype(np.uint64) * np.uint64(1 << 20) + np.uint64(family + 2)) >> np.uint64(32)
    return Code((np.cumsum(size) - size).astype(np.int32), size.astype(np.int32), np.array(bits, np.float32),
                hashed.astype(np.uint32), np.array(alone, np.float32)[nodes])


def joined(codes: list[Code]) -> Code:
    """Several codes as one: the symbols of the second follow those of the first."""
    before = np.cumsum([0] + [len(c.bit) for c in codes[:-1]])
    return Code(np.concatenate([c.at + b for c, b in zip(codes, before)]).astype(np.int32),
                *[np.concatenate([getattr(c, x) for c in codes]) for x in ("size", "bit", "node", "alone")])


def chained(first: Code, then: Code, before: np.ndarray) -> Code:
    """Of each symbol of ``then`` the path of ``before`` in ``first``, followed by its own."""
    lead = first.size[before].astype(np.int64)
    size = lead + then.size
    at = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(size)), size)
    inside = np.arange(len(owner)) - at[owner]
    place = np.where(inside < lead[owner], first.at[before][owner] + inside,
                     len(first.bit) + then.at[owner] + inside - lead[owner])
    return Code(at.astype(np.int32), size.astype(np.int32),
                *[np.concatenate([getattr(first, x), getattr(then, x)])[place] for x in ("bit", "node", "alone")])


@dataclass(frozen=True)
class Vocabulary:
    """What tasks share of the token counts."""
    hashes: np.ndarray      # of the frequent tokens, ascending
    first: np.ndarray       # the position of the first one with each beginning
    counts: np.ndarray
    leading: np.ndarray     # which of them are the most frequent
    leads: np.ndarray       # their hashes, behind that of no token
    symbol: np.ndarray      # their symbols in the code
    within: np.ndarray      # bits of theirs that no decision carries: none
    code: Code              # of the tokens, by their endings and each ending's tokens, then the end, then the escape
    spelling: Code          # of the bytes after each byte: symbol 256 * before + byte

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The position of each hash, and whether it is there."""
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        last = len(self.hashes) - 1
        at = self.first.take((hashes >> np.uint64(65 - len(self.first).bit_length())).astype(np.int64)).astype(np.int64)
        late = np.flatnonzero(self.hashes.take(at) < hashes)
        at[late] = np.minimum(np.searchsorted(self.hashes, hashes[late]), last)
        return at, self.hashes.take(at) == hashes


def vocabulary(hashes: np.ndarray, counts: np.ndarray, total: int, pairs: np.ndarray) -> Vocabulary:
    """Of the frequent tokens, the number of all tokens and the counts of byte pairs."""
    order = np.argsort(hashes)
    hashes, counts = hashes[order], counts[order]
    is_end = hashes == END
    ends, rest = int(counts[is_end].sum()), max(total - int(counts.sum()), 0)
    words = np.where(is_end, 0, counts)
    leading = np.zeros(len(hashes), dtype=bool)
    leading[np.lexsort((hashes, -words))[:LEADS]] = True
    endings, own = np.unique(hashes[~is_end] & _ENDING, return_inverse=True)
    sums = np.bincount(own, words[~is_end], minlength=len(endings)).astype(np.int64)
    n_words, n = len(own), len(endings)
    by = np.argsort(own, kind="stable")                 # ending after ending
    of_ending = np.split(words[~is_end][by], np.cumsum(np.bincount(own, minlength=n))[:-1])
    choices = joined([*[huffman(x.tolist(), i + 257) for i, x in enumerate(of_ending) if len(x)], huffman([1], 0), huffman([1], 0)])
    symbol, rank = np.full(len(hashes), n_words), np.empty(n_words, dtype=np.int64)
    rank[by] = np.arange(n_words)
    symbol[~is_end] = rank
    code = chained(huffman([*sums.tolist(), ends + 1, rest + 1], 0), choices, np.append(own[by], [n, n + 1]))
    spelling = joined([huffman((x + 1).tolist(), i + 1) for i, x in enumerate(pairs.reshape(256, 256))])
    leading &= ~is_end
    bits = len(hashes).bit_length() + 1
    first = np.searchsorted(hashes, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
    first = np.minimum(first, max(len(hashes) - 1, 0)).astype(np.int32)
    return Vocabulary(hashes, first, counts, leading, np.append(_START, hashes[leading]), symbol, np.zeros(len(hashes)), code, spelling)


# -------------------------------------------------------------------- decisions
@dataclass(frozen=True)
class Found:
    """The tokens' places in the vocabulary, and for each token the last
    leading one before it in its text, as its place in ``leads``."""
    at: np.ndarray
    there: np.ndarray
    lead: np.ndarray


def find(t: Tokens, voc: Vocabulary) -> Found:
    at, there = voc.find(t.hash)
    if not len(voc.hashes):
        return Found(at, there, np.zeros(len(at), np.int64))
    here = np.where(there & voc.leading[at], np.arange(len(t.hash)), -1)
    last = np.concatenate([[-1], np.maximum.accumulate(here)[:-1]])
    return Found(at, there, np.where(last >= t.edges[t.doc], np.cumsum(voc.leading)[at[last]], 0))


@dataclass(frozen=True)
class Steps:
    """Symbols of one code in the order of their tokens, and the contexts they
    are told from, as numbers below ``2 ** 32``."""
    owner: np.ndarray | None        # the position of the token in those asked for; None: each has one symbol
    symbol: np.ndarray
    contexts: list[np.ndarray]


def steps(t: Tokens, voc: Vocabulary, found: Found, which: np.ndarray) -> tuple[Steps, Steps]:
    """Of the tokens ``which``: each one's symbol, and the bytes of the spelled ones."""
    buf = t.buf if len(t.buf) else np.zeros(1, np.uint8)
    n_frequent = len(voc.code.size) - 2
    is_end = t.start[which] == t.end[which]
    own = voc.symbol[found.at[which]] if len(voc.symbol) else found.at[which]
    symbol = np.where(is_end, n_frequent, np.where(found.there[which], own, n_frequent + 1))
    before = np.where(which == t.edges[t.doc[which]], _START, t.hash[which - 1] & _ENDING).astype(np.int64)
    lead = found.lead[which]

    spelt = np.flatnonzero(symbol == n_frequent + 1)
    length = t.end[which[spelt]] - t.start[which[spelt]] + 1
    word = np.repeat(np.arange(len(spelt)), length)
    inside = np.arange(len(word)) - np.repeat(np.cumsum(length) - length, length)
    place = t.start[which[spelt]][word] + inside
    value = np.where(inside < length[word] - 1, buf[np.minimum(place, len(buf) - 1)], _WORD_END)

    def back(j):
        return np.where(inside >= j, buf[place - j], _WORD_END).astype(np.int64)

    one = back(1)
    two = one + 256 * back(2)
    four = two + 65536 * (back(3) + 256 * back(4))
    return (Steps(None, symbol, [before, lead]),
            Steps(spelt[word], one * 256 + value, [two + 65536 * lead[spelt][word], four]))


def _mixed(voc: Vocabulary, kind: int, k: int, context: np.ndarray) -> np.ndarray:
    """The hashes of ``contexts[k]`` in the token code (kind 0) or in spellings."""
    if kind == 0:
        hashed = voc.leads[context] if k else context.astype(np.uint64)
    else:
        hashed = context.astype(np.uint64) if k else (context & 0xFFFF).astype(np.uint64) * _ODD[0] + voc.leads[context >> 16]
    return (mix64(hashed * _ODD[k + 1] + _ODD[k + 1 + K]) >> np.uint64(32)).astype(np.uint32)


def _paths(code: Code, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each decision of the symbols' paths: whose it is, and its place in the code."""
    size = code.size[symbols].astype(np.int64)
    owner = np.repeat(np.arange(len(symbols)), size)
    path = np.repeat(code.at[symbols] - (np.cumsum(size) - size), size)
    path += np.arange(len(owner))
    return owner, path


def _slots(mixed: np.ndarray, node: np.ndarray, k: int) -> np.ndarray:
    """From the hashes of their contexts and their own."""
    mixed += node
    mixed *= _ODD32[k + 1]
    mixed >>= np.uint32(32 - SLOT_BITS)
    return mixed.astype(np.int64)


@dataclass(frozen=True)
class Decisions:
    """Of one kind, in the order of their tokens."""
    owner: np.ndarray       # the position of the token in those asked for
    bit: np.ndarray
    slots: list[np.ndarray]
    alone: np.ndarray


def decisions(t: Tokens, voc: Vocabulary, found: Found, which: np.ndarray) -> tuple[Decisions, Decisions]:
    """The decisions of the tokens ``which`` in the token code, and in spellings."""
    out = []
    for kind, (code, own) in enumerate(zip((voc.code, voc.spelling), steps(t, voc, found, which))):
        owner, path = _paths(code, own.symbol)
        node = code.node.take(path)
        slots = [_slots(_mixed(voc, kind, k, x).take(owner), node, k) for k, x in enumerate(own.contexts)]
        out.append(Decisions(owner if own.owner is None else own.owner.take(owner), code.bit.take(path), slots, code.alone.take(path)))
    return out[0], out[1]


class SlotCounts:
    """The zeros and ones of each slot. A symbol that follows the same context
    again takes the same decisions in the same slots: such pairs are counted
    first, ``HELD`` symbols at a time, and the decisions of the different ones
    are added as often as they occurred."""

    def __init__(self, voc: Vocabulary) -> None:
        self.voc, self.counts = voc, np.zeros(2 << SLOT_BITS, dtype=np.int32)
        self.held: list[list[list[np.ndarray]]] = [[[] for _ in range(1, K)] for _ in range(2)]
        self.n_held = 0

    def add(self, t: Tokens) -> None:
        found = find(t, self.voc)
        for begin in range(0, len(t.doc), SEGMENT):
            which = np.arange(begin, min(begin + SEGMENT, len(t.doc)))
            for held, own in zip(self.held, steps(t, self.voc, found, which)):
                for keys, context in zip(held, own.contexts):
                    keys.append(own.symbol << 32 | context)
                self.n_held += len(own.symbol)
            if self.n_held >= HELD:
                self.settle()

    def settle(self) -> np.ndarray:
        """The counts so far, zeros and ones by turns."""
        self.n_held = 0
        for kind, (code, held) in enumerate(zip((self.voc.code, self.voc.spelling), self.held)):
            for k, keys in enumerate(held):
                if not keys:
                    continue
                own, n = np.unique(np.concatenate(keys), return_counts=True)
                keys.clear()
                for i in range(0, len(own), SEGMENT):
                    part = own[i:i + SEGMENT]
                    owner, path = _paths(code, part >> 32)
                    at = _slots(_mixed(self.voc, kind, k, part & 0xFFFFFFFF).take(owner), code.node.take(path), k) * 2
                    at += code.bit.take(path) > 0
                    np.add.at(self.counts, at, n[i:i + SEGMENT].astype(np.int32).take(owner))
        return self.counts


# ----------------------------------------------------------------------- mixing
def predictions(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """The stretched prediction of each slot, in units of ``UNIT``; 0 where
    nothing was counted."""
    st = np.log((ones + PRIOR) / (zeros + PRIOR)) / UNIT
    return np.clip(np.rint(st), -32000, 32000).astype(np.int16)


class Mixer:
    """The weights and the refining map of some texts, for one kind of decisions."""

    def __init__(self, texts: int, first: np.ndarray) -> None:
        self.weights = np.ascontiguousarray(np.tile(first, (texts, 1)).T)
        centre = (np.arange(BUCKETS, dtype=np.float32) - BUCKETS // 2) / 2
        self.map = np.tile(1 / (1 + np.exp(-centre)), texts * GATES).astype(np.float32)

    def bits(self, x: list[np.ndarray], cell: np.ndarray, bit: np.ndarray, new: np.ndarray, texts: np.ndarray,
             first: np.ndarray) -> np.ndarray:
        """The bits of a block of decisions by text, those of ``texts`` (ascending)
        beginning at ``first``; then a step. ``cell`` is a decision's gate,
        ``GATES`` to a text; ``new`` are the decisions not of a text's last gate."""
        n = int(texts[-1] + 1) * GATES
        dot = x[0] * self.weights[0].take(cell)
        for k in range(1, K):
            dot += x[k] * self.weights[k].take(cell)
        np.minimum(np.maximum(dot, _MOST[0], out=dot), _MOST[1], out=dot)
        bucket = dot * _TWO
        np.minimum(np.maximum(np.rint(bucket, out=bucket), _BUCKET[0], out=bucket), _BUCKET[1], out=bucket)
        bucket += _BUCKET[1]
        place = cell * BUCKETS
        place += bucket.astype(np.int64)
        np.negative(dot, out=dot)
        p = np.exp(dot, out=dot)
        p += 1
        np.reciprocal(p, out=p)
        final = self.map.take(place)
        final += p
        final *= np.float32(0.5)
        np.minimum(np.maximum(final, _SURE[0], out=final), _SURE[1], out=final)
        final -= bit
        np.abs(final, out=final)
        np.log2(np.subtract(1, final, out=final), out=final)
        out = np.add.reduceat(final, first, dtype=np.float64)
        # the map: ones and zeros of each of its places
        place *= 2
        place += bit.astype(np.int64)
        zeros, ones = np.bincount(place, minlength=n * BUCKETS * 2).reshape(-1, 2).T
        times, own = zeros + ones, self.map[:n * BUCKETS]
        own += MAP_RATE * (ones * (1 - own) - zeros * own) / (1 + MAP_RATE * times)
        rate = RATE / np.sqrt(np.maximum(times.reshape(-1, BUCKETS).sum(axis=1), 1))
        error = np.subtract(bit, p, out=p)
        rest = cell.take(new)
        for k in range(K):
            moves = error * x[k]
            off = np.bincount(rest, moves.take(new), minlength=n).astype(np.float64).reshape(-1, GATES)      # whole numbers if empty
            off[texts, -1] = np.add.reduceat(moves, first, dtype=np.float64) - off[texts, :-1].sum(axis=1)
            self.weights[k, :n] += rate * off.ravel()
        return -out


def _inputs(d: Decisions, table: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The decisions' stretched predictions, and how many hashed contexts were seen."""
    found = [table.take(slots) for slots in d.slots]
    seen = np.zeros(len(d.owner), dtype=np.int8)
    for value in found:
        seen += value != 0
    return [d.alone, *[value * np.float32(UNIT) for value in found]], seen


def bits_of(t: Tokens, voc: Vocabulary, table: np.ndarray, found: Found) -> np.ndarray:
    """The bits of each text of ``t`` under the model."""
    size = np.diff(t.edges)
    texts = np.argsort(-size, kind="stable")            # longest first: the texts still at work are the first ones
    size = size[texts]
    mixers = [Mixer(len(texts), x) for x in WEIGHTS]
    bits = np.zeros(len(texts))
    for begin in range(0, int(size.max(initial=0)), SEGMENT):
        here = np.clip(size - begin, 0, SEGMENT)
        text = np.repeat(np.arange(len(texts)), here)
        place = np.arange(len(text)) - np.repeat(np.cumsum(here) - here, here)
        order = np.argsort(place // BLOCK, kind="stable")
        text, place = text[order], place[order]
        which = t.edges[texts][text] + begin + place
        block = place // BLOCK
        ends = np.searchsorted(block, np.arange(int(block[-1]) + 2))
        heads = np.flatnonzero(place % BLOCK == 0)      # the first token of each text's share of a block
        for part in np.split(np.arange(len(ends) - 1), np.flatnonzero(np.diff(ends[:-1] // TOGETHER)) + 1):
            a, b = ends[part[0]], ends[part[-1] + 1]
            own_heads = heads[np.searchsorted(heads, a):np.searchsorted(heads, b)]
            for mixer, d in zip(mixers, decisions(t, voc, found, which[a:b])):
                x, seen = _inputs(d, table)
                new = np.flatnonzero(seen != GATES - 1)
                cell = (text[a:b] * GATES).take(d.owner)
                cell += seen
                first = np.searchsorted(d.owner, own_heads - a)     # and its first decision, where it has one
                some = np.diff(first, append=len(d.owner)) > 0
                first, own, of = first[some], text[own_heads[some]], block[own_heads[some]]
                edges = np.searchsorted(of, np.append(part, part[-1] + 1))
                cuts = np.append(first, len(d.owner))[edges]
                news = np.searchsorted(new, cuts).tolist()
                for i, (p, q, u, v) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), cuts[:-1].tolist(), cuts[1:].tolist())):
                    if q > p:
                        bits[own[p:q]] += mixer.bits([z[u:v] for z in x], cell[u:v], d.bit[u:v], new[news[i]:news[i + 1]] - u,
                                                     own[p:q], first[p:q] - u)
    out = np.zeros(len(texts))
    out[texts] = bits
    return out


# ------------------------------------------------------------------------ Spark
@dataclass(frozen=True)
class Model:
    counts: DataFrame       # hash, n of every training token
    total: int              # training tokens
    distinct: int
    vocabulary: Vocabulary
    table: np.ndarray       # predictions by slot


def byte_pairs(t: Tokens) -> np.ndarray:
    """How often each byte follows each other one within the words of ``t``,
    a blank standing before and after each word."""
    if not len(t.buf):
        return np.zeros(1 << 16, dtype=np.int64)
    own = np.where(_WORD[t.buf], t.buf, np.uint8(_WORD_END)).astype(np.int64)
    total = np.bincount(own[:-1] * 256 + own[1:], minlength=1 << 16)
    word = t.start < t.end
    first, last = t.start[word], t.end[word]
    at_start = first[(first == 0) | (_WORD[t.buf[first - 1]])]        # words at the edge of a text have no blank there
    at_end = last[(last == len(t.buf)) | _WORD[t.buf[np.minimum(last, len(t.buf) - 1)]]] - 1
    within = np.zeros(len(t.buf), dtype=bool)
    within[at_start] = True
    across = np.flatnonzero(within[1:]) + 1
    across = across[_WORD[t.buf[across - 1]]]
    np.subtract.at(total, own[across - 1] * 256 + own[across], 1)      # of two texts
    np.add.at(total, _WORD_END * 256 + own[at_start], 1)
    np.add.at(total, own[at_end] * 256 + _WORD_END, 1)
    total[_WORD_END * 257] = 0
    return total


def _token_counts(texts: DataFrame) -> DataFrame:
    """``kind, key, n``: kind 0 token hashes, kind 1 pairs of bytes in words, with the blanks around them."""
    def count(batches):
        held, n_held, pairs = [], 0, np.zeros(1 << 16, dtype=np.int64)
        for part in text_slices(batches, limit=SLICE):
            t = tokens(part.column("text"))
            held.append(t.hash)
            n_held += len(t.hash)
            pairs += byte_pairs(t)
            if n_held >= HELD:
                yield counted(held)
                held, n_held = [], 0
        if n_held:
            yield counted(held)
        at = np.flatnonzero(pairs)
        yield framed(1, at, pairs[at])

    def counted(held):
        ids, n = np.unique(np.concatenate(held), return_counts=True)
        return framed(0, ids.view(np.int64), n)

    def framed(kind, key, n):
        return pa.RecordBatch.from_pydict({"kind": pa.array(np.full(len(key), kind), pa.int32()),
                                           "key": pa.array(key, pa.int64()), "n": pa.array(n, pa.int64())})

    return map_arrow(texts, count, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))


def _slot_counts(texts: DataFrame, vocabulary) -> DataFrame:
    """``part, at, zeros, ones``: per task and part of the slots, what occurred."""
    def count(batches):
        slots = SlotCounts(vocabulary.value)
        for part in text_slices(batches, limit=SLICE):
            slots.add(tokens(part.column("text")))
        counts = slots.settle().reshape(-1, 2)
        for i in range(0, len(counts), 1 << PART_BITS):
            own = counts[i:i + (1 << PART_BITS)]
            at = np.flatnonzero(own.any(axis=1))
            if len(at):
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([i >> PART_BITS], pa.int32()), "at": pa.array([at.astype(np.uint16).tobytes()]),
                    "n": pa.array([np.ascontiguousarray(own[at]).tobytes()])})

    return map_arrow(texts, count, "part int, at binary, n binary")


def _table(counted: DataFrame) -> np.ndarray:
    """The predictions of all slots, from counts added up part by part."""
    def add(batches):
        part, total = None, None
        for b in batches:
            for own, at, n in zip(*[b.column(c).to_pylist() for c in ("part", "at", "n")]):
                if own != part:
                    if part is not None:
                        yield framed(part, total)
                    part, total = own, np.zeros((1 << PART_BITS, 2), dtype=np.int64)
                total[np.frombuffer(at, np.uint16)] += np.frombuffer(n, np.int32).reshape(-1, 2)
        if part is not None:
            yield framed(part, total)

    def framed(part, total):
        return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()),
                                           "p": pa.array([predictions(total[:, 0], total[:, 1]).tobytes()])})

    dealt = counted.repartition("part").sortWithinPartitions("part")
    table = np.zeros(1 << SLOT_BITS, dtype=np.int16)
    for r in map_arrow(dealt, add, "part int, p binary").toLocalIterator():       # 2 ** SLOT_BITS predictions at most
        table[r["part"] << PART_BITS:(r["part"] + 1) << PART_BITS] = np.frombuffer(r["p"], np.int16)
    return table


def fit(texts: DataFrame) -> Model:
    """The model of the training texts (``text``)."""
    spark = texts.sparkSession
    texts = texts.select("text")
    counts = materialised(_token_counts(texts), "token-counts")
    own = counts.where("kind = 0").select(F.col("key").alias("hash"), "n")
    total, distinct = own.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    least = max(2, math.ceil(total * FREQUENT_SHARE))
    frequent = own.where(F.col("n") >= least).toPandas()                  # 1 / FREQUENT_SHARE rows at most
    pairs = np.zeros(1 << 16, dtype=np.int64)
    for r in counts.where("kind = 1").collect():                          # 65,536 rows at most
        pairs[r["key"]] = r["n"]
    voc = vocabulary(frequent["hash"].to_numpy().astype(np.int64).view(np.uint64),
                     frequent["n"].to_numpy().astype(np.int64), total, pairs)
    return Model(own, total, distinct, voc, _table(_slot_counts(texts, spark.sparkContext.broadcast(voc))))


def score(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """Per row of ``docs`` its columns ``keep``, and ``n_tokens, n_known,
    base_score, score`` (log10 probabilities by single tokens and by the
    model), ``bits_per_byte`` of the tokens and the blanks between them."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((model.vocabulary, model.table))
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches):
        voc, table = shared.value
        for part in text_slices(batches, limit=SLICE):
            t = tokens(part.column("text"))
            n_docs = part.num_rows
            found = find(t, voc)
            at, there = found.at, found.there
            known = np.bincount(t.doc[there], minlength=n_docs)
            own = voc.counts[at[there]] if len(voc.counts) else at[there]
            logs = np.bincount(t.doc[there], np.log10(own + 1.0), minlength=n_docs).astype(float)
            rest = np.flatnonzero(~there)
            order = rest[np.lexsort((t.hash[rest], t.doc[rest]))]
            new = np.ones(len(order), dtype=bool)
            new[1:] = (t.doc[order][1:] != t.doc[order][:-1]) | (t.hash[order][1:] != t.hash[order][:-1])
            first = np.flatnonzero(new)
            times = np.diff(np.append(first, len(order)))
            edges = pa.array(np.searchsorted(t.doc[order[first]], np.arange(n_docs + 1)), pa.int32())
            size = np.bincount(t.doc, t.end - t.start + 1, minlength=n_docs).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [part.column("__row"), *[part.column(c) for c in keep], pa.array(np.diff(t.edges), pa.int64()), pa.array(known, pa.int64()),
                 pa.array(logs, pa.float64()), pa.array(bits_of(t, voc, table, found)), pa.array(size),
                 pa.ListArray.from_arrays(edges, pa.array(t.hash[order[first]].view(np.int64))),
                 pa.ListArray.from_arrays(edges, pa.array(times, pa.int64()))],
                names=["__row", *keep, "n_tokens", "known", "logs", "bits", "size", "hash", "times"])

    numbered = docs.select(*keep, "text").withColumn("__row", F.monotonically_increasing_id())
    own = materialised(map_arrow(numbered, run, f"__row long, {fields}, n_tokens long, known long, logs double, bits double, "
                                 "size long, hash array<bigint>, times array<bigint>"), "scored")
    # the tokens whose counts are not shared
    rare = own.select("__row", F.explode(F.arrays_zip("hash", "times")).alias("t")).select("__row", "t.hash", "t.times")
    exact = (rare.join(model.counts.hint("merge"), "hash").groupBy("__row")
             .agg(F.sum("times").alias("more_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("more_logs")))
    floor = math.log10(model.total + model.distinct + 1)
    return (own.drop("hash", "times").join(exact.hint("merge"), "__row", "left")
            .select(*keep, "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
                    (F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) - F.col("n_tokens") * floor).alias("base_score"),
                    (F.col("bits") * -math.log10(2)).alias("score"), (F.col("bits") / F.col("size")).alias("bits_per_byte")))


def score_documents(docs: DataFrame) -> DataFrame:
    """Per document: ``doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score, bits_per_byte``, learnt from the rows not held out."""
    model = fit(docs.where(base_learns(F.col("doc_id"))))
    out = score(docs, model, ["doc_id"])
    return out.select("doc_id", (~base_learns(F.col("doc_id"))).alias("held_out"), "n_tokens", "n_known",
                      F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score", "bits_per_byte")

"""Operators 11, 12 and 13 against SQL and brute force, on tables with awkward rows."""

import hashlib
import math
import os
import random
import re
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import fixtures as X  # noqa: E402
from selfmend.llm import context_mixing as M  # noqa: E402
from selfmend.llm import conversation_trie as T  # noqa: E402
from selfmend.llm import hard_negatives as H  # noqa: E402
from selfmend.llm.queries import QUERIES  # noqa: E402


# ------------------------------------------------------------- 11: prefix trie
def _symbol(text):
    return hashlib.md5(text.encode()).hexdigest() + "%08X" % len(text)


def _brute_trie(convs):
    """Every prefix as a tuple of turns."""
    members, kids = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    out = {}
    for p in sorted(members, key=len, reverse=True):
        below = [out[k] for k in kids[p]]
        n = len(members[p])
        ends = sorted(c for c in members[p] if len(convs[c]) == len(p))
        out[p] = (min(members[p]), len(p), min(members[p[:-1]]) if p else None, n, len(kids[p]), sum(b[5] for b in below) or 1,
                  sum(b[6] for b in below) + (n - 1) * (len(p[-1]) if p else 0), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest())
    return set(out.values())


def _random_convs(seed):
    rng = random.Random(seed)
    convs = {}
    for c in rng.sample(range(-50, 500), rng.randint(1, 60)):
        convs[c] = [rng.choice(["a", "bb", "ccc"]) for _ in range(rng.choice([0, 1, 2, 3, 4, 8, 12]))]
        if rng.random() < 0.4:
            other = convs[rng.choice(list(convs))]
            convs[c] = other[:rng.randint(0, len(other))] + convs[c]
    return convs


@pytest.mark.parametrize("seed", range(60))
def test_forests_merge_across_boundaries(seed):
    """Sorted sequences cut into partitions anywhere, merged a few at a time."""
    convs, rng = _random_convs(seed), random.Random(seed)
    sequences = defaultdict(list)
    for c, turns in convs.items():
        sequences[bytes.fromhex("".join(map(_symbol, turns)))].append(c)
    items, forests, rows, fan = sorted(sequences.items()), [], [], rng.choice([2, 3, 32])
    while items:
        n = rng.randint(1, rng.choice([2, 5, 30]))
        new, spines = T.grow([(k, {len(k) // T.TURN: T.Node(len(c), min(c), own=min(c))}) for k, c in items[:n]], False, False)
        assert len(spines) <= 2
        rows += new
        forests.append(spines)
        items = items[n:]
    while forests:
        last = len(forests) <= fan
        grown = [T.grow([s for f in forests[i:i + fan] for s in f], last, True) for i in range(0, len(forests), fan)]
        rows += [r for new, _ in grown for r in new]
        forests = [] if last else [s for _, s in grown]
    named = {r[9]: r[0] for r in rows if r[9]}
    ends = {min(c): ",".join(map(str, sorted(c))) for c in sequences.values()}
    got = [(r[0], r[1], named[r[3]] if r[3] else r[2], *r[4:8], hashlib.sha256(ends.get(r[8], "").encode()).hexdigest()) for r in rows]
    assert len(got) == len(set(got)) and set(got) == _brute_trie(convs)


def test_trie_on_spark_with_small_parts(spark, monkeypatch):
    """Many partitions, several rounds, and ends hashed in pieces."""
    monkeypatch.setattr(T, "FAN", 2)
    monkeypatch.setattr(T, "PIECE", 3)
    convs = _random_convs(5) | {1000 + i: ["hot", "bb"] for i in range(50)}
    df = spark.createDataFrame([(c, [_symbol(t) for t in turns]) for c, turns in convs.items()], "conv_id long, turns array<string>")
    got = [tuple(r) for r in T.prefix_trie(df).collect()]
    assert len(got) == len(set(got)) and set(got) == _brute_trie(convs)


def test_trie_query_on_awkward_rows(spark, tmp_dir):
    rows = [(0, 1, "user", "x"), (0, 0, "system", "s"), (0, None, None, None), (0, 2, "user", None), (0, 2, "user", None),
            (5, 0, "user", "own"), (5, 1, "assistant", "日本語"), (105, 0, "user", "no base here"), (200, 7, "", ""), (203, 1, None, ""),
            (None, 0, "user", "nobody's"), (-7, 0, "user", "negative"), (300, 0, "a", "b:c"), (301, 0, "a:b", "c")]
    rows += [(1000 + i, j, "user", f"t{j}") for i in range(0, 30, 3) for j in range(4)] + [(400, j, "user", "long " * 50) for j in range(60)]
    rows += [(500 + i, 0, "user", "alone") for i in range(12)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name in ("key", "part", "side", "own", "n", "depth", "k", "symbol"):
        df = df.withColumn(name, F.lit("x"))
    X.written(spark, tmp_dir, conversations=df)
    got = X.same_as_sql(QUERIES["op11_conversation_trie"](spark, tmp_dir), tmp_dir, T.ORACLE, "conversations")
    assert len(got) > 60


def test_last_turns(spark):
    rows = [(1, 0, "u", "a"), (1, 1, "v", "b"), (2, 0, "u", "a"), (2, 1, "v", "c"), (3, 0, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    own = T.sequences(df)
    out = T.last_turns(T.prefix_trie(own), own, df)
    assert {tuple(r) for r in out.collect()} == {(1, 1, "u", "a"), (1, 2, "v", "b"), (2, 2, "v", "c"), (3, 1, "", "")}


def test_trie_of_nothing(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert T.prefix_trie(T.sequences(df)).count() == 0


# --------------------------------------------------------- 12: hard negatives
def _brute_negatives(rows, anchors=100, k=5, m=10):
    own = {}
    for vec_id, e, label in rows:
        if vec_id is None or label is None or not e or any(x is None or not math.isfinite(x) for x in e):
            continue
        v = ([math.floor(256 * float(np.float32(x))) for x in e], (label + 1) % 10 if vec_id % 7 == 0 else label)
        own[vec_id] = max(v, own.get(vec_id, v))
    out = set()
    for a, (v, label) in own.items():
        if a % anchors:
            continue
        score = {i: sum(x * y for x, y in zip(v, w)) for i, (w, _) in own.items() if i != a and len(w) == len(v)}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if own[i][1] == label][:k]:
            fits = [i for i in order if own[i][1] != label and 30 * score[p] <= 100 * score[i] <= 90 * score[p]]
            out |= {(a, p, n + 1, i, score[p], score[i]) for n, i in enumerate(fits[:m])}
    return out


def _embeddings(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    for name in ("dim", "v", "score", "own", "anchor", "n"):
        df = df.withColumn(name, F.lit("x"))
    return df


@pytest.mark.parametrize("chunk,block", [(4096, 256), (16, 2)])
def test_negatives_match_brute_force(spark, monkeypatch, tmp_dir, chunk, block):
    monkeypatch.setattr(H, "CHUNK_ROWS", chunk)
    monkeypatch.setattr(H, "BLOCK_ROWS", block)
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(0.02, 0.1, 8).astype(np.float32).tolist(), int(rng.integers(0, 3))) for i in range(420)]
    rows += [(500 + i, [0.05] * 8, i % 2) for i in range(60)]                                    # many ties
    rows += [(600, [0.0] * 8, 1), (601, [0.0] * 8, 1), (602, [1.0] * 8, 2), (700, [0.0, -0.5] * 4, 1), (701, [0.0, 0.5] * 4, 1)]
    rows += [(800, None, 1), (801, [0.1] * 8, None), (802, [0.1, None] * 4, 1), (803, [float("nan")] * 8, 1), (804, [float("inf")] * 8, 1),
             (None, [0.1] * 8, 1), (900, [], 1), (1000, [0.5, 0.25], 1), (1001, [0.5, 0.5], 1), (1002, [0.25, 0.25], 2)]
    rows += [rows[3], (3, [0.9] * 8, 0), (3, [0.9] * 8, 2)]                                      # repeated ids
    X.written(spark, tmp_dir, embeddings=_embeddings(spark, rows))
    out = QUERIES["op12_hard_negatives"](spark, tmp_dir)
    got = [tuple(r) for r in out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()]
    assert len(got) == len(set(got)) and set(got) == _brute_negatives(rows) and len(got) > 100
    if chunk == 4096:
        X.same_as_sql(out, tmp_dir, H.ORACLE, "embeddings")


def test_the_walk_over_all_pairs_needs_no_selection(spark):
    """The windows alone, over every pair of every anchor, sorted by the key."""
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-0.2, 0.4) for _ in range(4)], rng.randint(0, 2)) for i in range(301)]
    want = _brute_negatives(rows)
    v = {i: [math.floor(256 * float(np.float32(x))) for x in e] for i, e, _ in rows}
    label = {i: (y + 1) % 10 if i % 7 == 0 else y for i, _, y in rows}
    pairs = [(a, i, sum(x * y for x, y in zip(v[a], v[i])), label[i] != label[a]) for a in v if a % 100 == 0 for i in v if i != a]
    df = spark.createDataFrame(pairs, "anchor long, id long, score long, other boolean").repartition(7)
    assert {tuple(r) for r in H.negatives_of(df).collect()} == want


def test_scores_are_exact_beyond_doubles():
    q, v = np.array([[2 ** 28 + 1, 3]]), np.array([[2 ** 28 + 1, 1], [-(2 ** 28) - 3, 7]])
    assert H.scores(q, v).tolist() == [[(2 ** 28 + 1) ** 2 + 3, -(2 ** 28 + 1) * (2 ** 28 + 3) + 21]]


def test_negatives_of_nothing(spark):
    assert H.mine(spark.createDataFrame([], "vec_id long, embedding array<float>, label int"), F.col("vec_id") % 100 == 0).count() == 0


# ----------------------------------------------------------------- 13: scores
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def _tokens(text):
    lower = lambda w: bytes(b + 32 if 65 <= b <= 90 else b for b in w)
    return [lower(w) for w in WORD.findall((text or "").encode())] + [None]


def _learns(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 7 != 2


def _base(rows):
    counts = Counter(t for i, text in rows if _learns(i) for t in _tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    return [(len(t), sum(counts[x] > 0 for x in t), total, sum(math.log10((counts[x] + 1) / (total + distinct + 1)) for x in t))
            for t in (_tokens(text) for _, text in rows)]


def test_scores_on_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(M, "FREQUENT_SHARE", 0.002)              # so that many counts come by the join
    rows = [(r[0], r[1]) for r in X.documents()]
    out = M.score_documents(X.frame(spark)).collect()
    got = sorted([(r["doc_id"] is None, r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in out], key=repr)
    want = sorted([(i is None, i, not _learns(i), n, k, total, round(b, 6)) for (i, _), (n, k, total, b) in zip(rows, _base(rows))], key=repr)
    assert got == want
    assert all(r["score"] < 0 and math.isfinite(r["score"]) and r["bits_per_byte"] > 0 for r in out)


def _slow_bits(t, voc, table):
    """The model decision by decision, in plain Python."""
    out = []
    for a, b in zip(t.edges[:-1], t.edges[1:]):
        weights = [[[float(w) for w in row] for row in first] for first in M.WEIGHTS]
        maps = [[[1 / (1 + math.exp(-(j - M.BUCKETS // 2) / 2)) for j in range(M.BUCKETS)] for _ in range(M.GATES)] for _ in M.WEIGHTS]
        found, bits = M.find(t, voc), 0.0
        for start in range(a, b, M.BLOCK):
            which = np.arange(start, min(b, start + M.BLOCK))
            at, there = found.at[which], found.there[which]
            bits += float(voc.within[at[there]].sum()) if len(voc.within) else 0.0
            for kind, d in enumerate(M.decisions(t, voc, found, which)):
                steps, moves = defaultdict(list), defaultdict(list)
                for n in range(len(d.owner)):
                    looked = [int(table[s[n]]) for s in d.slots]
                    x = [float(d.alone[n]), *[v * M.UNIT for v in looked]]
                    gate, bit = sum(v != 0 for v in looked), float(d.bit[n])
                    dot = max(-16.0, min(16.0, sum(p * q for p, q in zip(x, weights[kind][gate]))))
                    p = 1 / (1 + math.exp(-dot))
                    bucket = int(max(-(M.BUCKETS // 2), min(M.BUCKETS // 2, np.rint(np.float32(dot) * 2)))) + M.BUCKETS // 2
                    refined = maps[kind][gate][bucket]
                    final = min(max((p + refined) / 2, M.FLOOR), 1 - M.FLOOR)
                    bits -= math.log2(final if bit else 1 - final)
                    steps[gate].append([(bit - p) * v for v in x])
                    moves[gate, bucket].append(bit - refined)
                for gate, s in steps.items():
                    for k in range(M.K):
                        weights[kind][gate][k] += M.RATE / math.sqrt(len(s)) * sum(v[k] for v in s)
                for (gate, bucket), s in moves.items():
                    maps[kind][gate][bucket] += M.MAP_RATE * sum(s) / (1 + M.MAP_RATE * len(s))
        out.append(bits)
    return np.array(out)


def _model(texts, share=0.002):
    t = M.tokens(pa.array(texts, pa.string()))
    ids, n = np.unique(t.hash, return_counts=True)
    frequent = n >= max(2, share * n.sum())
    voc = M.vocabulary(ids[frequent], n[frequent], int(n.sum()), M.byte_pairs(t))
    counts = np.zeros((1 << M.SLOT_BITS, 2), dtype=np.int64)
    for d in M.decisions(t, voc, M.find(t, voc), np.arange(len(t.doc))):
        for s in d.slots:
            np.add.at(counts, (s.astype(np.int64), d.bit.astype(np.int64)), 1)
    return voc, M.predictions(counts[:, 0], counts[:, 1])


def test_bits_match_brute_force(monkeypatch):
    texts = [r[1] for r in X.documents() if r[1] is None or len(r[1]) < 3000]
    voc, table = _model(texts[::2])
    t = M.tokens(pa.array(texts, pa.string()))
    want = _slow_bits(t, voc, table)
    assert np.allclose(M.bits_of(t, voc, table, M.find(t, voc)), want, rtol=1e-3, atol=0.05)
    monkeypatch.setattr(M, "SEGMENT", 2 * M.BLOCK)               # long texts go in segments, with what they learnt
    assert np.allclose(M.bits_of(t, voc, table, M.find(t, voc)), want, rtol=1e-3, atol=0.05)


def test_codes_are_complete_and_probabilities_add_up():
    """Over all tokens of a small language (and the escape), the mixed
    probabilities of the next token add up to one."""
    voc, table = _model(["aa ba aa ca", "ba aa aa", "ca da aa da", "aa ba"] * 5, share=0.0)
    assert len(voc.hashes) == 5 and math.isclose(sum(2.0 ** -s for s in voc.code.size.tolist()), 1.0)
    first = lambda text: M.tokens(pa.array([text]))
    total = 0.0
    for word in ("aa", "ba", "ca", "da", ""):
        t = first(f"aa {word}")
        d, _ = M.decisions(t, voc, M.find(t, voc), np.array([1]))
        x, seen = M._inputs(d, table)
        p = 1 / (1 + np.exp(-sum(v * M.WEIGHTS[0][seen, k] for k, v in enumerate(x))))
        found = M.find(t, voc)
        total += float(np.prod(np.where(d.bit > 0, p, 1 - p))) * (2.0 ** -voc.within[found.at[1]] if found.there[1] else 0.0)
    t = first("aa unknown")
    d, _ = M.decisions(t, voc, M.find(t, voc), np.array([1]))
    x, seen = M._inputs(d, table)
    p = 1 / (1 + np.exp(-sum(v * M.WEIGHTS[0][seen, k] for k, v in enumerate(x))))
    assert math.isclose(total + float(np.prod(np.where(d.bit > 0, p, 1 - p))), 1.0, rel_tol=1e-5)


def test_the_choice_among_tokens_of_an_ending_is_mixed_from_contexts():
    """``xaa`` and ``yaa`` share their ending and their frequency; which of them
    follows is told by the token before, so it costs far less than a bit."""
    texts = ["po xaa qu yaa"] * 200
    voc, table = _model(texts, share=0.0)
    t = M.tokens(pa.array(["po xaa qu yaa", "po yaa qu xaa"]))
    right, wrong = M.bits_of(t, voc, table, M.find(t, voc))
    assert wrong - right > 4
    d, _ = M.decisions(t, voc, M.find(t, voc), np.array([1]))
    assert len({(int(s), int(b)) for s, b in zip(d.slots[0], d.bit)}) == voc.code.size[voc.symbol[M.find(t, voc).at[1]]]
    assert not voc.within.any()


def test_slots_are_counted_once_per_different_pair(monkeypatch):
    """Each symbol's decisions in a context are looked up once however often
    the two occur, and counted as often."""
    texts = ["po xaa qu yaa unknown", "po yaa qu xaa other", None, "PO xaa"] * 50
    t = M.tokens(pa.array(texts, pa.string()))
    voc, _ = _model(texts, share=0.1)
    want = np.zeros((1 << M.SLOT_BITS, 2), dtype=np.int64)
    for d in M.decisions(t, voc, M.find(t, voc), np.arange(len(t.doc))):
        for s in d.slots:
            np.add.at(want, (s.astype(np.int64), d.bit.astype(np.int64)), 1)
    looked, slots = [], M._slots
    monkeypatch.setattr(M, "_slots", lambda mixed, node, k: looked.append(len(node)) or slots(mixed, node, k))
    for held in (M.HELD, 100):                                   # in one go, and in many
        monkeypatch.setattr(M, "HELD", held)
        monkeypatch.setattr(M, "SEGMENT", min(M.SEGMENT, held))
        looked.clear()
        counted = M.SlotCounts(voc)
        counted.add(t)
        assert (counted.settle().reshape(-1, 2) == want).all() and (counted.settle().reshape(-1, 2) == want).all()
        if held > 100:
            assert 0 < sum(looked) < want.sum() / 10


def test_bits_where_every_context_was_seen():
    """No decision is left to the other gates, in a short text and a long one."""
    texts = ["po xaa qu yaa qu qu", "po xaa qu", "po xaa po qu yaa qu po"] * 20
    voc, table = _model(texts, share=0.0)
    table = np.where(table == 0, 50, table)
    t = M.tokens(pa.array(["po xaa qu yaa qu " * 300, "po xaa qu"], pa.string()))
    assert np.allclose(M.bits_of(t, voc, table, M.find(t, voc)), _slow_bits(t, voc, table), rtol=1e-5)


def test_frequent_tokens_are_found_by_their_beginnings():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 700):
        all_ = np.unique(np.concatenate([rng.integers(0, 1 << 64, 2 * n, dtype=np.uint64),
                                         np.array([0, 1, (1 << 64) - 1], np.uint64), rng.integers(0, 99, n, dtype=np.uint64)]))
        own = all_[np.sort(rng.permutation(len(all_))[:n])]
        voc = M.vocabulary(own, np.full(len(own), 2), 3 * n, np.zeros(1 << 16, np.int64))
        at, there = voc.find(all_)
        assert (there == np.isin(all_, own)).all() and (not n or (own[at[there]] == all_[there]).all())


def test_byte_pairs_brute_force():
    for seed in range(60):
        rng = random.Random(seed)
        texts = ["".join(rng.choice("aB é\n\t x") for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(0, 6))]
        want = np.zeros(1 << 16, dtype=int)
        for text in texts:
            for w in _tokens(text)[:-1]:
                for a, b in zip(b" " + w, w + b" "):
                    want[a * 256 + b] += 1
        assert (M.byte_pairs(M.tokens(pa.array(texts, pa.string()))) == want).all()


def test_learning_and_scores_that_tell_texts_apart(spark):
    """Held-out prose costs fewer bits than the same letters shuffled, and text
    that repeats the corpus fewer still."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    model = M.fit(docs.where(M.base_learns(F.col("doc_id"))))
    prose = docs.where(~M.base_learns(F.col("doc_id"))).where(F.length("text") > 400).select("text").limit(30).collect()
    seen = docs.where(M.base_learns(F.col("doc_id"))).where(F.length("text") > 400).select("text").limit(30).collect()
    rng = random.Random(1)
    noise = ["".join(rng.sample(r["text"], len(r["text"]))) for r in prose]
    rows = [(kind, t) for kind, texts in (("prose", [r["text"] for r in prose]), ("seen", [r["text"] for r in seen]), ("noise", noise)) for t in texts]
    out = M.score(spark.createDataFrame(rows, "kind string, text string"), model, ["kind"])
    cost = {r["kind"]: r["b"] for r in out.groupBy("kind").agg(F.avg("bits_per_byte").alias("b")).collect()}
    assert cost["seen"] < cost["prose"] < 3.2 < cost["noise"]


def test_scores_without_rows_or_training(spark):
    assert M.score_documents(X.frame(spark, [])).count() == 0
    rows = [r for r in X.documents() if not _learns(r[0])]
    out = M.score_documents(X.frame(spark, rows)).collect()
    assert rows and all((r["n_known"], r["train_tokens"], r["base_score"]) == (0, 0, 0.0) and r["score"] < 0 for r in out)

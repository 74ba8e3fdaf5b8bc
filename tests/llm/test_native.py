"""Operators 1, 2, 4 and 6 against their SQL, on tables with awkward rows."""

import sys
import os

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import fixtures as X  # noqa: E402
from selfmend.llm import licences, line_quality, quotes, site_lines  # noqa: E402

PYTHON = ("Python", "Pandas", "Arrow")


@pytest.fixture(scope="module")
def docs_dir(spark, tmp_path_factory):
    return X.written(spark, str(tmp_path_factory.mktemp("docs")), documents=X.frame(spark))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_site_lines(spark, docs_dir):
    docs = spark.read.parquet(f"{docs_dir}/documents.parquet")
    out = site_lines.report(docs, "source")
    rows = X.same_as_sql(out, docs_dir, site_lines.ORACLE, "documents")
    assert sum(r[1] for r in rows) >= 18 and not any(p in plan(out) for p in PYTHON)
    kept = site_lines.drop_boilerplate(docs, "source")
    assert kept.columns == docs.columns and kept.count() == docs.count()
    assert kept.where(F.lower("text").contains("footer are ours 12")).count() == 0
    assert kept.where(F.lower("text").contains("footer are ours 7")).count() == 0 or site_lines.MIN_PAGES > 3
    assert kept.where(F.col("n_chars") != F.length("text")).count() == 0
    assert kept.where("text IS NULL").count() == 2


def test_copies_of_a_page_are_not_boilerplate(spark):
    page = "first line of the copied page\nsecond line of it"
    rows = [(i, page, "h") for i in range(40)] + [(100 + i, f"own line {i}\nfooter of the site", "h") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r["doc_id"]: r["text"] for r in site_lines.drop_boilerplate(docs, "source").collect()}
    assert kept == {i: page if i < 100 else f"own line {i - 100}" for i, _, _ in rows}


def test_line_quality(spark, docs_dir):
    docs = spark.read.parquet(f"{docs_dir}/documents.parquet")
    out = line_quality.assess(docs, "source")
    rows = X.same_as_sql(out, docs_dir, line_quality.ORACLE, "documents")
    assert len(rows) == docs.count() and not any(p in plan(out) for p in PYTHON)


def test_the_method_rejects_documents(spark):
    """The verdict is not the base rule's alone: documents whose length is
    boilerplate, in words or in share, go, others lose the lines and stay."""
    footer = "subscribe to our letter and read all of this week on the site today"          # 14 words
    letters = lambda n: "".join("abcdefghij"[int(x)] for x in str(n))
    prose = lambda i, n: " ".join(f"word{letters(i)}x{letters(j)}" for j in range(n))
    rows = [(i, prose(i, 60) + "\n" + footer, "h") for i in range(20)]
    rows += [(100 + i, prose(100 + i, 45) + "\n" + footer, "h") for i in range(5)]            # 45 words of their own
    rows += [(200 + i, prose(200 + i, 55) + "\n" + "\n".join([footer] * 5), "h") for i in range(5)]      # less than half
    rows += [(300 + i, prose(300 + i, 51), "other") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r["doc_id"]: r for r in line_quality.assess(docs, "source").collect()}
    assert all(not r["base_failed"] for i, r in out.items() if i < 200 or i >= 300)
    assert {i for i, r in out.items() if r["kept"]} == {r[0] for r in rows if r[0] < 100 or r[0] >= 300}
    kept = {r["doc_id"]: r["text"] for r in line_quality.cleaned(docs, "source").collect()}
    assert kept == {i: t.split("\n")[0] for i, t, _ in rows if i < 100 or i >= 300}


def test_repeated_words_brute_force(spark):
    import random
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abc") for _ in range(n)) for n in (0, 1, 2, 3, 4, 5, 9, 30, 200)]

    def brute(text):
        w = text.split()
        seen: dict = {}
        for i in range(len(w) - 2):
            seen.setdefault(tuple(w[i:i + 3]), []).append(i)
        return len({i + k for at in seen.values() if len(at) > 1 for i in at for k in range(3)})

    got = spark.createDataFrame([(t,) for t in texts], "text string").select(
        "text", line_quality.repeated_words(line_quality.words(F.col("text"))).alias("n")).collect()
    assert [r["n"] for r in got] == [brute(r["text"]) for r in got]


def test_depleted_documents_go_and_clean_ones_stay(spark):
    rows = [(i, X.prose(i, 80) + "\n" + " ".join(["footer"] * 20), "en", "h", 0) for i in range(30)]
    rows += [(100 + i, f"{i} " + X.prose(0, 10) + "\n" + "\n".join([" ".join(["footer"] * 20)] * 4), "en", "h", 0) for i in range(3)]
    got = {r["doc_id"]: r["kept"] for r in line_quality.assess(X.frame(spark, rows), "source").collect()}
    assert all(got[i] for i in range(30))
    assert not any(got[i] for i in (100, 101, 102))


def test_cleaned_documents_lack_the_frequent_lines(spark):
    footer = " ".join(["footer"] * 20)
    rows = [(i, X.prose(i, 80) + f"\n{footer}", "en", "h", 0) for i in range(30)]
    rows += [(100 + i, X.prose(300 + i, 60) + "\n" + "\n".join([footer] * 4), "en", "h", 0) for i in range(3)]
    rows += [(200, "too short", "en", "h", 0), (201, None, "en", "h", None), (202, X.prose(400, 90), "en", None, 0)]
    docs = X.frame(spark, rows)
    for limits in ({}, {"min_left": 0.0}, {"min_documents": 99}):
        out = line_quality.cleaned(docs, "source", **limits)
        assert out.columns == docs.columns and not any(p in plan(out) for p in PYTHON)
        kept = {r["doc_id"]: r["kept"] for r in line_quality.assess(docs, "source", **limits).collect()}
        got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in out.collect()}
        assert set(got) == {i for i, k in kept.items() if k}
        strip = "min_documents" not in limits
        for i, text, *_ in rows:
            if i in got:
                want = "\n".join(x for x in text.split("\n") if x != footer or not strip)
                assert got[i] == (want, len(want))
        if not limits:
            assert set(got) == {r[0] for r in rows} - {100, 101, 102, 200, 201}
    assert line_quality.cleaned(X.frame(spark, []), "source").count() == 0


def test_licences(spark, tmp_dir):
    mit = licences.TEXTS[0][2]
    rows = [(0, "The MIT Licence\n\n" + mit, "en", "s", 0), (1, "MIT License\n\nCopyright (c) 2020 A. Person\n\n" + mit.upper(), "en", "s", 0),
            (2, mit.replace(",", " ;").replace("sublicense", "sub-license").replace("\n", "  "), "en", "s", 0),
            (3, mit + " and more", "en", "s", 0), (4, licences.TEXTS[4][2].replace("copyright", "Copyright"), "en", "s", 0),
            (5, "Some words.\nReleased under the MIT License.\nlicensed under the APACHE Licence, version 2.0", "en", "s", 0),
            (6, None, "en", "s", 0), (7, "", "en", "s", 0), (8, "...", "en", "s", 0), (None, mit, "en", "s", 0), (1, mit, None, None, None)]
    where = X.written(spark, tmp_dir, documents=X.frame(spark, rows))
    out = licences.scan(spark.read.parquet(f"{where}/documents.parquet"))
    X.same_as_sql(out, where, licences.ORACLE, "documents")
    got = {r["doc_id"]: (r["licence"], r["notices"]) for r in out.collect()}
    assert [got[i][0] for i in (1, 2, 4, None)] == ["MIT", "MIT", "BSD-3-Clause", "MIT"]
    assert got[0][0] is None and got[3][0] is None       # another title, more text: not the entire text
    assert got[5] == (None, "Apache-2.0,MIT") and got[6] == (None, "") and got[7] == (None, "")
    assert not any(p in plan(out) for p in PYTHON)


def test_holder_lines_long_texts_and_further_licences(spark, tmp_dir):
    mit = licences.TEXTS[0][2]
    holders = ["Copyright Some Name", "  * Copyright The Foo Project Authors", "copyright (c) 2020 X", "© X", "Copyright\t2001-2004, A, B"]
    rows = [(i, f"MIT License\n\n{h}\n\n{mit}", "en", "s", 0) for i, h in enumerate(holders)]
    rows += [(10, f"Copyright notices matter\n{mit}", "en", "s", 0), (11, mit.replace("The above copyright", "The above\ncopyright"), "en", "s", 0),
             (12, "Licensed under CC BY-NC 4.0.\nlicensed under cc by-nc-sa 3.0", "en", "s", 0), (13, "own terms, all of them", "en", "s", 0)]
    folder, long = "/usr/share/common-licenses", []
    if os.path.isdir(folder):
        for i, name in enumerate(("Apache-2.0", "GPL-2", "GPL-3", "LGPL-2.1", "MPL-2.0", "CC0-1.0")):
            if os.path.exists(f"{folder}/{name}"):
                long.append((100 + i, name))
                rows.append((100 + i, open(f"{folder}/{name}", encoding="utf-8").read().upper(), "en", "s", 0))
    where = X.written(spark, tmp_dir, documents=X.frame(spark, rows))
    docs = spark.read.parquet(f"{where}/documents.parquet")
    X.same_as_sql(licences.scan(docs), where, licences.ORACLE, "documents")
    further = spark.createDataFrame([("Own", "OWN terms; all of them!"), ("Also-own", "own terms all of them"), (None, "x"), ("X", None), ("No-MIT", mit)],
                                    "licence string, text string")
    got = {r["doc_id"]: (r["licence"], r["notices"]) for r in licences.scan(docs, further).collect()}
    assert [got[i][0] for i in range(5)] == ["MIT"] * 5 and got[10][0] is None and got[11][0] == "MIT"
    assert got[12] == (None, "CC-BY-NC-4.0,CC-BY-NC-SA-3.0") and got[13][0] == "Also-own"
    assert all(got[i][0].startswith(name) for i, name in long)


def test_licence_catalogue_is_canonical_alike(spark):
    texts = [t for _, _, t in licences.TEXTS] + [t for _, t in licences.NOTICES]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(licences.canonical(F.col("t")).alias("c"))
    assert [r["c"] for r in got.collect()] == [licences.canonical_text(t) for t in texts]


CONVERSATION = [
    (1, 0, "a", "Shall we meet on Monday?\n\nBring the notes."),
    (1, 1, "b", "> Shall we meet\n> on Monday?\nYes, at nine."),
    (1, 2, "c", "On Friday, A wrote:\n> Bring the notes.\nWhich notes?"),
    (1, 3, "a", ">> Bring the notes.\n> Which notes?\nThe blue ones."),
    (1, 4, "b", "An unrelated message."),
    (1, 5, "d", ">>> bring the NOTES\n>> Which notes?\n> The blue ones.\nFound them.\n> Something nobody said\nBye."),
    (1, 6, "a", "Yes, at nine."),
    (1, 7, "b", "> Yes, at nine.\nAgain?"),
    (1, 8, "b", "   indented > not a quote"),
    (2, 0, "a", "> Shall we meet on Monday?\nquoted from another conversation"),
    (2, 1, "b", None), (2, 2, "b", ""), (2, 3, "b", ">\n> \n>>"), (2, 4, "b", "> > > deep\nx"),
    (None, 0, "a", "> x\ny"), (3, None, "a", "Hello there"), (3, None, "b", "> Hello there\nhi"), (3, 1, "c", "> Hello there\nho"),
    (4, 1, "a", "same turn"), (4, 1, "b", "> same turn\nno"), (4, 1, "a", "same turn"), (4, 2, "a", "> same turn\nyes"),
]


@pytest.mark.parametrize("block", [1000, 2])
def test_quotes(spark, tmp_dir, monkeypatch, block):
    monkeypatch.setattr(quotes, "BLOCK_TURNS", block)
    df = spark.createDataFrame(CONVERSATION, "conv_id long, turn long, role string, text string") \
        .withColumn("own", F.lit(1)).withColumn("mid", F.lit("x"))
    where = X.written(spark, tmp_dir, conversations=df)
    out = quotes.conversations(spark.read.parquet(f"{where}/conversations.parquet"))
    X.same_as_sql(out, where, quotes.ORACLE, "conversations")
    got = {(r["conv_id"], r["turn"], r["role"]): r for r in out.collect()}
    first = [got[1, t, r] for t, r in ((0, "a"), (1, "b"), (2, "c"), (3, "a"), (4, "b"), (5, "d"))]
    assert [r["parent_turn"] for r in first] == [None, 0, 0, 2, None, 3]
    assert [r["reply_depth"] for r in first] == [0, 1, 1, 2, 0, 3]
    assert [r["position"] for r in first] == [0, 1, 2, 3, 0, 4]
    assert first[3]["quotes"] == "1:2,2:0" and first[5]["text"] == "Found them.\nBye." and first[2]["text"] == "Which notes?"
    assert got[1, 7, "b"]["parent_turn"] == 6              # the latest that says so
    assert got[1, 8, "b"]["text"] == "   indented > not a quote"
    assert got[2, 0, "a"]["parent_turn"] is None and got[2, 1, "b"]["text"] is None
    assert got[4, 1, "a"]["copies"] == 2 and got[4, 1, "b"]["parent_turn"] is None and got[4, 2, "a"]["parent_turn"] == 1
    assert not any(p in plan(out) for p in PYTHON)


def test_deep_thread_and_hot_conversation(spark):
    """A chain of replies, and a phrase that everybody quotes, in one conversation."""
    chain = [(7, i, "u", f"message number {i}" if i == 0 else f"> message number {i - 1}\nmessage number {i}") for i in range(60)]
    hot = [(8, i, "u", f"> me too\nme too {i}\n\nme too") for i in range(300)]
    df = spark.createDataFrame(chain + hot, "conv_id long, turn long, role string, text string")
    out = quotes.conversations(df)
    got = {(r["conv_id"], r["turn"]): r for r in out.collect()}
    assert len(got) == 360
    assert all(got[7, i]["reply_depth"] == i and got[7, i]["position"] == i and got[7, i]["thread_turn"] == 0 for i in range(60))
    assert all(got[8, i]["parent_turn"] == (i - 1 if i else None) for i in range(300))


@pytest.mark.parametrize("run", [
    lambda d: site_lines.report(d, "source"), lambda d: site_lines.drop_boilerplate(d, "source"),
    lambda d: line_quality.assess(d, "source"), licences.scan])
def test_empty_table(spark, run):
    assert run(X.frame(spark, [])).count() == 0


def test_empty_conversations(spark):
    assert quotes.conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0

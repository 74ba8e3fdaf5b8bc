"""The registered queries against SQL at sf0.01, and the pipeline against a
brute-force version at sf0.001."""

import os
import sys
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import corpus_pipeline  # noqa: E402
import oracle_harness as H  # noqa: E402
import test_python as P  # noqa: E402
from selfmend.llm import icws, langid, secret_scan, site_lines  # noqa: E402
from selfmend.llm.queries import ORACLE, QUERIES  # noqa: E402

SMALL, CHECK = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_sql(spark, key):
    ok, message = H.compare(spark, H.duck(CHECK), key, CHECK)
    assert ok, message


def test_queries_are_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
    assert [k for k, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "secret_scan", "packing"]


def test_pipeline_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = {r["doc_id"]: r.asDict() for r in docs.collect()}
    # 9: documents with a language
    model = langid.fit(langid.train_rows(docs))
    best, score = langid.score_texts([r["text"] for r in rows.values()], model)
    fits = langid.fits([r["text"] for r in rows.values()], model)
    kept = {i: r for (i, r), b, s, f in zip(rows.items(), best, score, fits) if b != "und" and s >= 0.5 and f}
    # 2: lines on more than a tenth of a source's pages, copies being one page
    norm = lambda x: " ".join(x.replace("\t", " ").split(" ")).strip(" ").lower() if x.strip(" ") else ""
    norm = lambda x, f=norm: " ".join([w for w in f(x).split(" ") if w])
    pages, total = {}, {}
    for i, r in kept.items():
        total.setdefault(r["source"], set()).add(r["text"])
        for line in {norm(x) for x in r["text"].split("\n")} - {""}:
            pages.setdefault((r["source"], line), set()).add(r["text"])
    often = {k for k, v in pages.items() if len(v) >= site_lines.MIN_PAGES and len(v) > site_lines.MAX_RATIO * len(total[k[0]])}
    texts = {i: "\n".join(x for x in r["text"].split("\n") if (r["source"], norm(x)) not in often) for i, r in kept.items()}
    # 7: one of each class
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    classes = P.brute_classes(list(texts.items()), icws.inverse_frequencies(frame))
    texts = {min(ids): texts[min(ids)] for ids in classes.values()}
    # 10: secrets masked; 8: packed
    texts = {i: secret_scan.masked(t) for i, t in texts.items()}
    out = corpus_pipeline.run(spark, SMALL).collect()
    n, histogram = P.check_packing(out, list(texts.items()), 2048)
    assert n == P.brute_best_fit(histogram, 2048)
    assert 0 < len(texts) < len(rows)


def test_a_drifting_copy_group_leaves_one_whole_text(spark):
    """A third of a source are near copies of one text; all pages end in one line."""
    footer = "\nAll rights to the footer are ours"
    first = P.X.prose(7, 240)
    copies = [P.X.edited(first, i, i % 4) for i in range(40)]
    rows = [(i, t + footer, "en", "s", len(t + footer)) for i, t in enumerate(copies + [P.X.prose(1000 + i, 150) for i in range(80)])]
    docs = P.X.frame(spark, rows, extra=False)
    cut = {r["doc_id"]: r["text"] for r in site_lines.drop_boilerplate(docs, "source", max_share=0.5).collect()}
    assert cut == {r[0]: r[1][:-len(footer)] for r in rows}
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, SMALL)
    left = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert left == {i: t for i, t in cut.items() if i == 0 or i >= 40}


def test_stages_keep_columns(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SMALL).columns == docs.columns


def test_pipeline_on_an_empty_table(spark, tmp_dir):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    docs.where(F.lit(False)).write.parquet(f"{tmp_dir}/documents.parquet")
    assert corpus_pipeline.run(spark, tmp_dir).count() == 0

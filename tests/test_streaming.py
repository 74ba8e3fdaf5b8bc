"""The landing-folder stream: per-file status, quarantine, metrics, restart."""

import os

from pyspark.sql import functions as F

import ticket_fixture as TF
from conftest import write_lines
from selfmend.plans import scoring
from selfmend.plans import tickets as T
from selfmend.streaming import ServeConfig, serve


def _permuted(lines):
    rows = [line.split(",") for line in lines]
    order = list(reversed(range(len(rows[0]))))
    return [",".join(r[i] for i in order) for r in rows]


def _short(lines):
    rows = [line.split(",") for line in lines]
    drop = rows[0].index("覆盖场景")
    return [",".join(v for i, v in enumerate(r) if i != drop) for r in rows]


def _ragged(lines):
    """Rows 1 and 2 cut short, row 3 with an extra field; the rest intact."""
    out = list(lines)
    out[1] = ",".join(out[1].split(",")[:10])
    out[2] = ",".join(out[2].split(",")[:-1])
    out[3] = out[3] + ",extra"
    return out


def test_stream_scores_checks_and_quarantines(spark, tmp_dir):
    lines = TF.ticket_lines()
    landing = f"{tmp_dir}/landing"
    write_lines(f"{landing}/a.csv", lines)
    write_lines(f"{landing}/day2/b.csv", _permuted(lines))
    write_lines(f"{landing}/c.csv", _short(lines))
    write_lines(f"{landing}/d.csv", lines[:1])
    write_lines(f"{landing}/e.csv", [])
    write_lines(f"{landing}/notes.txt", ["not a ticket file"])
    write_lines(f"{landing}/f.csv", _ragged(lines))
    fitted = scoring.fit(spark.createDataFrame(TF.training_rows()), T.SPEC)
    cfg = ServeConfig(landing=landing, output=f"{tmp_dir}/out", quarantine=f"{tmp_dir}/q",
                      metrics=f"{tmp_dir}/m", checkpoint=f"{tmp_dir}/ck", archive_dir=f"{tmp_dir}/archive",
                      processing_time=None, max_files_per_trigger=2)
    serve(spark, T.SPEC, fitted, cfg).awaitTermination()

    m = {r["source_file"]: (r["status"], r["n_rows"], r["n_ragged"])
         for r in spark.read.parquet(cfg.metrics).collect()}
    # the zero-byte file never reaches the file stream; nothing to score
    assert m == {"a.csv": (0, 44, 0), "b.csv": (0, 44, 0), "c.csv": (2, 44, 0), "d.csv": (1, 0, 0),
                 "f.csv": (0, 44, 3)}
    out = spark.read.json(cfg.output)
    assert out.count() == 88 + 41
    # a permuted header is read by name: same ids, same predictions for both files
    ab = out.where(F.col("source_file").isin("a.csv", "b.csv"))
    by_file = ab.groupBy("问题点编号").agg(F.count_distinct("prediction").alias("k"), F.count("*").alias("n"))
    assert by_file.where((F.col("k") != 1) | (F.col("n") != 2)).count() == 0
    q = spark.read.json(cfg.quarantine)
    got = {(r["reason"], r["status"], r["n"]) for r in q.groupBy("reason", "status").agg(F.count("*").alias("n")).collect()}
    assert got == {("missing_columns", 2, 44), ("ragged", 3, 3)}
    batches = spark.read.parquet(cfg.metrics).select("batch_id").distinct().count()
    assert batches >= 2  # at most two files per micro-batch

    # restart on the same checkpoint: nothing is processed twice
    serve(spark, T.SPEC, fitted, cfg).awaitTermination()
    assert spark.read.parquet(cfg.metrics).count() == 5
    # input is never deleted: every file is in the landing folder or the archive
    names = set()
    for root in (landing, cfg.archive_dir):
        for d, _, files in os.walk(root):
            names |= set(files)
    assert {"a.csv", "b.csv", "c.csv", "d.csv", "e.csv", "f.csv"} <= names


def test_retried_batch_replaces_its_output(spark, tmp_dir):
    """A micro-batch run again (e.g. after a failure before its commit)
    overwrites its own outputs instead of adding to them."""
    from selfmend.streaming.serve import process_batch
    landing = f"{tmp_dir}/landing"
    write_lines(f"{landing}/a.csv", TF.ticket_lines())
    write_lines(f"{landing}/f.csv", _ragged(TF.ticket_lines()))
    fitted = scoring.fit(spark.createDataFrame(TF.training_rows()), T.SPEC)
    cfg = ServeConfig(landing=landing, output=f"{tmp_dir}/out", quarantine=f"{tmp_dir}/q",
                      metrics=f"{tmp_dir}/m", checkpoint=f"{tmp_dir}/ck", processing_time=None)
    batch = spark.createDataFrame([(f"file:{landing}/a.csv",), (f"file:{landing}/f.csv",)], "path string")
    for _ in range(2):
        process_batch(spark, batch, 7, T.SPEC, fitted, cfg)
    assert spark.read.json(cfg.output).count() == 44 + 41
    assert spark.read.json(cfg.quarantine).count() == 3
    assert spark.read.parquet(cfg.metrics).count() == 2


def test_file_names_with_spaces_percent_and_glob_characters(spark, tmp_dir):
    """Metadata paths are URI-encoded and reader paths are globs: names with
    a space, %, + or [ ] { } still get their rows counted and scored."""
    landing = f"{tmp_dir}/landing"
    names = ["工单 11.csv", "a+b [2].csv", "p%41{x}.csv"]
    for name in names:
        write_lines(f"{landing}/{name}", TF.ticket_lines())
    fitted = scoring.fit(spark.createDataFrame(TF.training_rows()), T.SPEC)
    cfg = ServeConfig(landing=landing, output=f"{tmp_dir}/out", quarantine=f"{tmp_dir}/q",
                      metrics=f"{tmp_dir}/m", checkpoint=f"{tmp_dir}/ck", processing_time=None)
    serve(spark, T.SPEC, fitted, cfg).awaitTermination()
    m = {r["source_file"]: (r["status"], r["n_rows"]) for r in spark.read.parquet(cfg.metrics).collect()}
    assert m == {n: (0, 44) for n in names}
    out = spark.read.json(cfg.output)
    assert {r["source_file"]: r["n"] for r in out.groupBy("source_file").agg(F.count("*").alias("n")).collect()} \
        == {n: 44 for n in names}


def test_gbk_landing_files(spark, tmp_dir):
    """Landing files in GBK: header and rows decoded with the configured charset."""
    landing = f"{tmp_dir}/landing"
    os.makedirs(landing)
    with open(f"{landing}/g.csv", "wb") as f:
        f.write(("\n".join(TF.ticket_lines()) + "\n").encode("gbk"))
    fitted = scoring.fit(spark.createDataFrame(TF.training_rows()), T.SPEC)
    cfg = ServeConfig(landing=landing, output=f"{tmp_dir}/out", quarantine=f"{tmp_dir}/q",
                      metrics=f"{tmp_dir}/m", checkpoint=f"{tmp_dir}/ck", processing_time=None,
                      encoding="GBK")
    serve(spark, T.SPEC, fitted, cfg).awaitTermination()
    assert [(r["status"], r["n_rows"]) for r in spark.read.parquet(cfg.metrics).collect()] == [(0, 44)]
    out = spark.read.json(cfg.output)
    want = sorted(line.split(",")[TF.HEADER.index("地市")] for line in TF.ticket_lines()[1:])
    assert sorted(r["地市"] for r in out.collect()) == want


def test_same_file_name_in_two_folders_stays_apart(spark, tmp_dir):
    landing = f"{tmp_dir}/landing"
    for day in ("day1", "day2"):
        write_lines(f"{landing}/{day}/a.csv", TF.ticket_lines())
    fitted = scoring.fit(spark.createDataFrame(TF.training_rows()), T.SPEC)
    cfg = ServeConfig(landing=landing, output=f"{tmp_dir}/out", quarantine=f"{tmp_dir}/q",
                      metrics=f"{tmp_dir}/m", checkpoint=f"{tmp_dir}/ck", processing_time=None)
    serve(spark, T.SPEC, fitted, cfg).awaitTermination()
    out = spark.read.json(cfg.output)
    by_path = {r["source_path"].split("/landing/")[1]: r["n"]
               for r in out.groupBy("source_path").agg(F.count("*").alias("n")).collect()}
    assert by_path == {"day1/a.csv": 44, "day2/a.csv": 44}


def test_unseen_category_rows_are_quarantined_not_fatal(spark, tmp_dir):
    """Under handle_invalid='error' a category the model never saw would fail
    the batch on every replay; the stream quarantines those rows (status 4)
    and scores the rest."""
    from selfmend.functions.rules import OneOf, Range, RuleSet
    rules = RuleSet((Range("n", 0, 10), OneOf("c", ("a", "b", "z"))))
    train = spark.createDataFrame([("1", "a", "y"), ("2", "b", "n"), ("3", "a", "y"), ("4", "b", "n")],
                                  "n string, c string, lab string")
    spec = scoring.ScoringSpec(rules, "lab", num_trees=3, max_depth=2)
    fitted = scoring.fit(train, spec)
    landing = f"{tmp_dir}/landing"
    write_lines(f"{landing}/a.csv", ["n,c", "5,a", "6,z", "7,b", "8,q"])
    cfg = ServeConfig(landing=landing, output=f"{tmp_dir}/out", quarantine=f"{tmp_dir}/q",
                      metrics=f"{tmp_dir}/m", checkpoint=f"{tmp_dir}/ck", processing_time=None)
    serve(spark, spec, fitted, cfg).awaitTermination()
    m = spark.read.parquet(cfg.metrics).collect()
    assert [(r["status"], r["n_rows"], r["n_unseen"]) for r in m] == [(0, 4, 1)]
    assert sorted(r["n"] for r in spark.read.json(cfg.output).collect()) == ["5", "7", "8"]
    q = spark.read.json(cfg.quarantine).collect()
    assert [(r["n"], r["c"], r["status"], r["reason"]) for r in q] == [("6", "z", 4, "unseen_category")]


def test_repeated_header_names(spark, tmp_dir):
    """A repeated optional column is renamed and the file scored; a repeated
    required column is ambiguous: status 2, rows quarantined. Neither fails
    the batch."""
    from selfmend.functions.rules import OneOf, Range, RuleSet
    rules = RuleSet((Range("n", 0, 10), OneOf("c", ("a", "b"))))
    train = spark.createDataFrame([("1", "a", "y"), ("2", "b", "n"), ("3", "a", "y"), ("4", "b", "n")],
                                  "n string, c string, lab string")
    spec = scoring.ScoringSpec(rules, "lab", num_trees=3, max_depth=2)
    fitted = scoring.fit(train, spec)
    landing = f"{tmp_dir}/landing"
    write_lines(f"{landing}/opt.csv", ["n,c,note,note", "5,a,x,y", "6,b,,"])
    write_lines(f"{landing}/req.csv", ["n,c,c", "7,a,b"])
    cfg = ServeConfig(landing=landing, output=f"{tmp_dir}/out", quarantine=f"{tmp_dir}/q",
                      metrics=f"{tmp_dir}/m", checkpoint=f"{tmp_dir}/ck", processing_time=None)
    serve(spark, spec, fitted, cfg).awaitTermination()
    m = {r["source_file"]: (r["status"], r["n_rows"], r["missing"]) for r in spark.read.parquet(cfg.metrics).collect()}
    assert m == {"opt.csv": (0, 2, ""), "req.csv": (2, 1, "c")}
    out = spark.read.json(cfg.output)
    assert sorted((r["n"], r["note"], r["note_2"]) for r in out.collect()) == [("5", "x", "y"), ("6", "", "")]
    q = spark.read.json(cfg.quarantine).collect()
    assert [(r["n"], r["status"]) for r in q] == [("7", 2)]


def test_an_unreadable_file_does_not_hold_up_the_batch(spark, tmp_dir):
    """A file that is gone when its batch runs gets status 5; the rest is scored."""
    from selfmend.operators import quality
    from selfmend.streaming.serve import process_batch
    landing = f"{tmp_dir}/landing"
    write_lines(f"{landing}/a.csv", TF.ticket_lines())
    fitted = scoring.fit(spark.createDataFrame(TF.training_rows()), T.SPEC)
    cfg = ServeConfig(landing=landing, output=f"{tmp_dir}/out", quarantine=f"{tmp_dir}/q",
                      metrics=f"{tmp_dir}/m", checkpoint=f"{tmp_dir}/ck", processing_time=None)
    batch = spark.createDataFrame([(f"file:{landing}/a.csv",), (f"file:{landing}/gone.csv",)], "path string")
    process_batch(spark, batch, 0, T.SPEC, fitted, cfg)
    assert {r["source_file"]: (r["status"], r["n_rows"]) for r in spark.read.parquet(cfg.metrics).collect()} \
        == {"a.csv": (0, 44), "gone.csv": (quality.UNREADABLE, 0)}
    assert spark.read.json(cfg.output).count() == 44


def test_batches_are_bounded():
    import pytest
    with pytest.raises(ValueError):
        ServeConfig(landing="l", output="o", quarantine="q", metrics="m", checkpoint="c", max_files_per_trigger=None)


def test_archive_holds_what_earlier_batches_read(spark, tmp_dir):
    landing = f"{tmp_dir}/landing"
    for i in range(3):
        write_lines(f"{landing}/f{i}.csv", TF.ticket_lines())
    fitted = scoring.fit(spark.createDataFrame(TF.training_rows()), T.SPEC)
    cfg = ServeConfig(landing=landing, output=f"{tmp_dir}/out", quarantine=f"{tmp_dir}/q", metrics=f"{tmp_dir}/m",
                      checkpoint=f"{tmp_dir}/ck", archive_dir=f"{tmp_dir}/archive", processing_time=None, max_files_per_trigger=1)
    serve(spark, T.SPEC, fitted, cfg).awaitTermination()
    archived = [f for _, _, files in os.walk(cfg.archive_dir) for f in files if f.endswith(".csv")]
    assert len(archived) == 2


def _small_spec():
    from selfmend.functions.rules import OneOf, Range, RuleSet
    return scoring.ScoringSpec(RuleSet((Range("n", 0, 10), OneOf("c", ("a", "b", "z")))), "lab", num_trees=3, max_depth=2)


def _small_model(spark, flipped=False):
    rows = [("1", "a", "y"), ("2", "b", "n"), ("3", "a", "y"), ("4", "b", "n")]
    if flipped:
        rows = [(n, c, {"y": "n", "n": "y"}[x]) for n, c, x in rows]
    return scoring.fit(spark.createDataFrame(rows, "n string, c string, lab string"), _small_spec())


def _config(tmp_dir, **more):
    return ServeConfig(landing=f"{tmp_dir}/landing", output=f"{tmp_dir}/out", quarantine=f"{tmp_dir}/q", metrics=f"{tmp_dir}/m",
                       checkpoint=f"{tmp_dir}/ck", processing_time=None, **more)


def _batch(spark, tmp_dir, *names):
    return spark.createDataFrame([(f"file:{tmp_dir}/landing/{n}",) for n in names], "path string")


def test_header_lines_inside_a_file_are_no_rows(spark, tmp_dir):
    """A file put together from two: both read paths give the same two rows."""
    from selfmend.sources import delimited as src
    write_lines(f"{tmp_dir}/landing/two.csv", ["id,n,c", "1,5,a", "id,n,c", "2,6,b", "id,n,c", "3,6", "id,n,c"])
    cfg = _config(tmp_dir)
    serve(spark, _small_spec(), _small_model(spark), cfg).awaitTermination()
    assert [(r["n_rows"], r["n_ragged"], r["status"]) for r in spark.read.parquet(cfg.metrics).collect()] == [(3, 1, 0)]
    out = spark.read.json(cfg.output)
    assert sorted((r["id"], r["n"], r["c"], r["predictedLabel"]) for r in out.collect()) == [("1", "5", "a", "y"), ("2", "6", "b", "n")]
    batch = src.read_delimited(spark, cfg.landing)
    assert sorted(map(tuple, batch.collect())) == sorted((r["id"], r["n"], r["c"]) for r in out.collect())
    assert [r["value"] for r in src.read_ragged(spark, cfg.landing).collect()] == ["3,6"]
    q = spark.read.json(cfg.quarantine).collect()
    assert [(r["landed_line"], r["reason"]) for r in q] == [("3,6", "ragged")]


def test_gbk_header_lines_inside_a_file(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/landing")
    with open(f"{tmp_dir}/landing/g.csv", "wb") as f:
        f.write("编号,n,c\n一,5,a\n编号,n,c\n二,6,b\n".encode("gbk"))
    cfg = _config(tmp_dir, encoding="GBK")
    serve(spark, _small_spec(), _small_model(spark), cfg).awaitTermination()
    assert sorted(r["编号"] for r in spark.read.json(cfg.output).collect()) == ["一", "二"]


def test_fifty_layouts_take_one_scan_and_one_write(spark, monkeypatch, tmp_dir):
    """Files whose columns are permuted and named differently: one frame is
    scored and written, it reads the files once, and every row is right."""
    import itertools
    import sys
    from selfmend.operators import sinks
    from selfmend.streaming.serve import process_batch
    module = sys.modules["selfmend.streaming.serve"]
    names, want = [], set()
    for i, columns in enumerate(itertools.islice(itertools.product(itertools.permutations(("id", "n", "c")), range(9)), 50)):
        header = [*columns[0], *[f"extra{k}" for k in range(columns[1])]]
        rows = [{"id": f"{i}-{j}", "n": str(j), "c": "ab"[j % 2], **{h: f"{h}-{i}" for h in header[3:]}} for j in range(3)]
        write_lines(f"{tmp_dir}/landing/f{i}.csv", [",".join(header), *[",".join(r[h] for h in header) for r in rows]])
        names.append(f"f{i}.csv")
        want |= {(r["id"], r["n"], r["c"], len(header) - 3, "yn"[j % 2]) for j, r in enumerate(rows)}
    cfg, writes, scored, own = _config(tmp_dir), [], [], module.score
    writer = sinks._writer
    monkeypatch.setattr(sinks, "_writer", lambda df, *a: (writes.append(df), writer(df, *a))[1])
    monkeypatch.setattr(module, "score", lambda *a: (scored.append(a[0]), own(*a))[1])
    process_batch(spark, _batch(spark, tmp_dir, *names), 0, _small_spec(), _small_model(spark), cfg)
    assert len(writes) == len(scored) == 1
    plan = writes[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and not any(x in plan for x in ("Exchange", "InMemoryTableScan", "Join"))
    out = spark.read.json(cfg.output).collect()
    assert {(r["id"], r["n"], r["c"], sum(r[f"extra{k}"] is not None for k in range(8)), r["predictedLabel"]) for r in out} == want
    assert len(out) == 150
    m = spark.read.parquet(cfg.metrics).collect()
    assert {(r["n_rows"], r["status"]) for r in m} == {(3, 0)} and len(m) == 50


def test_counts_come_from_the_write(spark, monkeypatch, tmp_dir):
    """Observed counts equal the files', over many files and splits, with
    nothing cached; a colliding checksum is salted away."""
    import sys
    module = sys.modules["selfmend.streaming.serve"]
    want = {}
    for i in range(120):
        good, short, new = i % 5, i % 3, i % 2
        header, lines = "n,c", ["5,a"] * good + ["1"] * short + ["1,z"] * new
        if i % 10 == 7:
            header, lines = "n,x", ["5,a"] * good + ["1"] * short
        write_lines(f"{tmp_dir}/landing/f{i}.csv", [header, *lines])
        missing = i % 10 == 7
        want[f"f{i}.csv"] = (len(lines), short, 0 if missing else new, (1 if not lines else 2 if missing else 0))
    cfg, fitted = _config(tmp_dir), _small_model(spark)
    for method in ("persist", "cache"):
        monkeypatch.setattr(type(spark.range(0)), method, lambda *a, **k: (_ for _ in ()).throw(AssertionError("cached")))
    checksum = module.zlib.crc32
    monkeypatch.setattr(module.zlib, "crc32", lambda b: checksum(b) if b[:1] != b"0" else 1)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        module.process_batch(spark, _batch(spark, tmp_dir, *want), 0, _small_spec(), fitted, cfg)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    m = {r["source_file"]: (r["n_rows"], r["n_ragged"], r["n_unseen"], r["status"]) for r in spark.read.parquet(cfg.metrics).collect()}
    assert m == want
    assert spark.read.json(cfg.output).count() + spark.read.json(cfg.quarantine).count() == sum(x[0] for x in want.values())


def test_a_batch_becomes_visible_at_once(spark, monkeypatch, tmp_dir):
    """A run killed while it writes leaves nothing visible; the next run of the
    batch replaces everything; readers by commit see committed batches only."""
    import pytest
    from selfmend.streaming import commits, committed, committed_batches
    from selfmend.streaming.serve import process_batch
    write_lines(f"{tmp_dir}/landing/a.csv", ["n,c", "5,a", "6,b", "7"])
    write_lines(f"{tmp_dir}/landing/b.csv", ["n,c", "8,a"])
    cfg, fitted, spec = _config(tmp_dir), _small_model(spark), _small_spec()
    process_batch(spark, _batch(spark, tmp_dir, "a.csv"), 3, spec, fitted, cfg)
    own = commits.Batch.commit
    monkeypatch.setattr(commits.Batch, "commit", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        process_batch(spark, _batch(spark, tmp_dir, "b.csv"), 4, spec, fitted, cfg)
    monkeypatch.setattr(commits.Batch, "commit", own)
    assert spark.read.json(cfg.output).count() == 2
    # moved, but not committed: readers by commit do not see it
    monkeypatch.setattr(commits, "write_small", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        process_batch(spark, _batch(spark, tmp_dir, "b.csv"), 4, spec, fitted, cfg)
    monkeypatch.undo()
    assert committed(spark, cfg.output, spark.read.json(cfg.output)).count() == 2
    process_batch(spark, _batch(spark, tmp_dir, "b.csv"), 4, spec, fitted, cfg)
    assert committed(spark, cfg.output, spark.read.json(cfg.output)).count() == 3
    # run again with another outcome: the rows set aside before are gone
    write_lines(f"{tmp_dir}/landing/a.csv", ["n,c", "5,a"])
    process_batch(spark, _batch(spark, tmp_dir, "a.csv"), 3, spec, fitted, cfg)
    assert spark.read.json(cfg.output).count() == 2 and spark.read.parquet(cfg.metrics).count() == 2
    assert not os.path.exists(f"{cfg.quarantine}/batch_id=3")
    assert sorted((r["batch_id"], r["n_files"], len(r["outputs"])) for r in committed_batches(spark, cfg.output).collect()) == [(3, 1, 2), (4, 1, 2)]
    assert os.listdir(f"{cfg.output}/_staging") == []


def test_model_versions_are_taken_up_while_serving(spark, tmp_dir):
    """Each new micro-batch is scored by the newest version; a batch that is
    run again keeps its own; a half-written version is not seen."""
    import pytest
    from selfmend.streaming import publish
    from selfmend.streaming.serve import process_batch
    models = f"{tmp_dir}/models"
    cfg, spec = _config(tmp_dir, models=models), _small_spec()
    write_lines(f"{tmp_dir}/landing/a.csv", ["n,c", "5,a"])
    with pytest.raises(Exception, match="no model version"):
        process_batch(spark, _batch(spark, tmp_dir, "a.csv"), 0, spec, None, cfg)
    publish(spark, _small_model(spark), models, "9")
    serve(spark, spec, None, cfg).awaitTermination()
    publish(spark, _small_model(spark, flipped=True), models, "10")
    os.makedirs(f"{models}/_staging/11/model")
    write_lines(f"{tmp_dir}/landing/b.csv", ["n,c", "5,a"])
    serve(spark, spec, None, cfg).awaitTermination()
    read = lambda: sorted((r["source_file"], r["model_version"], r["predictedLabel"]) for r in
                          spark.read.schema("source_file string, model_version string, predictedLabel string").json(cfg.output).collect())
    want = [("a.csv", "9", "y"), ("b.csv", "10", "n")]
    assert read() == want
    process_batch(spark, _batch(spark, tmp_dir, "a.csv"), 0, spec, None, cfg)      # as after a restart
    assert read() == want
    with pytest.raises(ValueError, match="there already"):
        publish(spark, _small_model(spark), models, "10")


def test_train_and_serve_job(spark, tmp_dir):
    """The runnable job over ticket files: train from files whose columns
    moved, set a ragged row aside, then drain a landing folder."""
    from selfmend import job
    rows = [r.asDict() if hasattr(r, "asDict") else r for r in spark.createDataFrame(TF.training_rows()).collect()]
    header = list(rows[0])
    lines = [",".join("" if r[c] is None else str(r[c]) for c in header) for r in rows]
    half = len(lines) // 2
    write_lines(f"{tmp_dir}/train/a.csv", [",".join(header), *lines[:half]])
    write_lines(f"{tmp_dir}/train/b.csv", _permuted([",".join(header), *lines[half:]]) + ["short,row"])
    import pytest
    with pytest.raises(ValueError, match="wrong number of fields"):
        job.train(spark, f"{tmp_dir}/train", f"{tmp_dir}/model")
    job.train(spark, f"{tmp_dir}/train", f"{tmp_dir}/model", f"{tmp_dir}/ragged")
    assert spark.read.json(f"{tmp_dir}/ragged").count() == 1
    write_lines(f"{tmp_dir}/landing/t.csv", TF.ticket_lines())
    job.main(["serve", "--model", f"{tmp_dir}/model", "--landing", f"{tmp_dir}/landing", "--output", f"{tmp_dir}/out",
              "--metrics", f"{tmp_dir}/m", "--quarantine", f"{tmp_dir}/q", "--checkpoint", f"{tmp_dir}/ck", "--once"])
    assert spark.read.json(f"{tmp_dir}/out").count() == TF.N


def test_landing_keeps_unknown_and_new_kinds(spark, tmp_dir):
    """Events of a NULL or new kind land and reach the per-source sink."""
    from selfmend.plans import queries as Q
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    k = F.col("event_id") % 5
    changed = events.withColumn("event_type", F.when(k == 0, None).when(k == 1, F.lit("refund")).otherwise(F.col("event_type")))
    changed.coalesce(1).write.parquet(f"{tmp_dir}/events.parquet")
    out = Q.REGISTRY["sink_per_source_file"](spark, tmp_dir)
    want = {r["event_type"]: r["n"] for r in changed.groupBy("event_type").agg(F.count("*").alias("n")).collect()}
    assert {r["source"]: r["n"] for r in out.groupBy("source").agg(F.count("*").alias("n")).collect()} == want
    assert out.count() == events.count()

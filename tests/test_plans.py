"""Plan shapes that carry the scale design: scoring is narrow, aggregates
combine map-side before their shuffle, the id join shuffles each side once
and broadcasts nothing, scans read only the columns a query uses, and no
registered query runs Python per row."""

import re

import pytest

from conftest import SF_SMALL, write_lines

PYTHON_EVAL = re.compile(r"BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas")


@pytest.fixture(scope="module")
def plans(spark):
    from selfmend.plans import queries as Q
    q = Q.queries()
    return {k: q[k](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString() for k in sorted(q)}


def test_no_registered_query_runs_python_per_row(plans):
    offenders = [k for k, p in plans.items() if PYTHON_EVAL.search(p)]
    assert offenders == []


def test_no_registered_query_broadcasts(plans):
    assert [k for k, p in plans.items() if "Broadcast" in p] == []


@pytest.mark.parametrize("key", ["flow_score_batch", "flow_append_prediction", "flow_forest_score", "ml_forest_score",
                                 "dq_check_and_fill", "dq_validate_row", "feat_pipeline_apply"])
def test_scoring_and_validation_never_shuffle(plans, key):
    assert "Exchange" not in plans[key]


@pytest.mark.parametrize("key", ["join_left_outer_result", "join_project_result"])
def test_id_join_shuffles_each_side_once(plans, key):
    p = plans[key]
    assert p.count("Exchange") == 2
    assert "SortMergeJoin" in p and "LeftOuter" in p


@pytest.mark.parametrize("key", ["agg_value_counts", "agg_mode", "agg_fill_values", "dq_exception_fields",
                                 "agg_describe", "eval_confusion_matrix", "stream_batch_metrics"])
def test_aggregates_combine_before_the_shuffle(plans, key):
    """Every exchange feeding an aggregate sits on a partial aggregate, so a
    hot value costs one row per task in the shuffle."""
    lines = plans[key].splitlines()
    for i, line in enumerate(lines):
        if "Exchange" in line and i + 1 < len(lines):
            assert "partial_" in lines[i + 1] or "Aggregate" in lines[i + 1], (key, lines[i + 1])


def test_scans_read_only_used_columns(plans):
    scan = re.search(r"FileScan parquet \[([^\]]*)\]", plans["agg_value_counts"]).group(1)
    assert sorted(c.split("#")[0] for c in scan.split(",")) == ["lang", "source"]
    scan = re.search(r"FileScan parquet \[([^\]]*)\]", plans["fit_minmax"]).group(1)
    assert sorted(c.split("#")[0] for c in scan.split(",")) == [
        "l_discount", "l_extendedprice", "l_quantity", "l_tax"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_scan_for_fill_values_and_one_hot(plans):
    assert plans["agg_fill_values"].count("FileScan") == 1
    assert plans["feat_one_hot"].count("FileScan") == 1


@pytest.mark.parametrize("key", ["sink_delimited_text", "sink_json", "sink_csv_header", "sink_parquet_time_cell"])
def test_frames_given_to_writers_are_map_only(spark, monkeypatch, key):
    """The registered query reads back what was written; this looks at what the writer gets."""
    from selfmend.operators import sinks
    from selfmend.plans import queries as Q
    seen, writer = [], sinks._writer
    monkeypatch.setattr(sinks, "_writer", lambda df, *a: (seen.append(plan_of(df)), writer(df, *a))[1])
    Q.REGISTRY[key](spark, SF_SMALL)
    assert len(seen) == 1
    assert not any(x in seen[0] for x in ("Exchange", "Coalesce", "Broadcast")) and not PYTHON_EVAL.search(seen[0])


def test_scores_inside_a_micro_batch_are_map_only(spark, monkeypatch, tmp_dir):
    import ticket_fixture as TF
    from selfmend.plans import scoring
    from selfmend.plans import tickets as T
    from selfmend.streaming import ServeConfig
    import sys
    module = sys.modules["selfmend.streaming.serve"]
    write_lines(f"{tmp_dir}/landing/a.csv", TF.ticket_lines())
    fitted = scoring.fit(spark.createDataFrame(TF.training_rows()), T.SPEC)
    cfg = ServeConfig(landing=f"{tmp_dir}/landing", output=f"{tmp_dir}/out", quarantine=f"{tmp_dir}/q",
                      metrics=f"{tmp_dir}/m", checkpoint=f"{tmp_dir}/ck")
    seen, own = [], module.score
    monkeypatch.setattr(module, "score", lambda *a: (seen.append(own(*a)), seen[-1])[1])
    batch = spark.createDataFrame([(f"file:{tmp_dir}/landing/a.csv",)], "path string")
    module.process_batch(spark, batch, 0, T.SPEC, fitted, cfg)
    plan = plan_of(seen[0])
    assert len(seen) == 1 and "Exchange" not in plan and not PYTHON_EVAL.search(plan)


def test_hot_row_is_split_in_the_id_join(spark):
    """Two thirds of the input under one id: the join's large partition is split."""
    from pyspark.sql import functions as F
    from selfmend.operators import attach
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        left = spark.range(0, 60_000, 1, 6).select(
            F.when(F.col("id") % 3 < 2, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("v"))
        res = left.select("k").distinct().select("k", F.lit(1.0).alias("prediction"), F.lit("L").alias("predictedLabel"),
                                                 F.lit(0.5).alias("probability"))
        out = attach.join_results(left, res, "k")
        out.write.format("noop").mode("overwrite").save()
        joined = attach.join_results(left, res, "k")
        assert joined.count() == 60_000
        rows = joined.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert rows < 30_000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)

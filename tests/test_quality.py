"""Validation, fill, status and statistics on synthetic ticket rows."""

import pytest
from pyspark.sql import functions as F

import ticket_fixture as TF
from conftest import write_lines
from selfmend.functions.numeric import strict_double
from selfmend.functions.rules import OneOf, Range, RuleSet
from selfmend.operators import quality, stats
from selfmend.plans import tickets as T
from selfmend.sources import delimited as src


@pytest.fixture()
def tickets(spark, tmp_dir):
    path = write_lines(f"{tmp_dir}/tickets.csv", TF.ticket_lines())
    return src.read_delimited(spark, path)


def test_read_keeps_every_row_and_blank_as_empty(tickets):
    assert tickets.columns == TF.HEADER
    assert tickets.count() == TF.N
    # blanks are '' (never NULL) straight after the read
    assert tickets.where(F.col("区县").isNull()).count() == 0
    assert tickets.where(F.col("区县") == "").count() == 17


def test_validation_matches_golden_counts(tickets):
    checked = quality.validate(tickets, T.RULES)
    assert checked.columns == list(T.RULES.required)
    nulls = checked.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in checked.columns]).first()
    got = {c: nulls[c] for c in checked.columns if nulls[c]}
    assert got == TF.GOLDEN


def test_exception_fields_lists_exactly_the_bad_columns(tickets):
    rows = {r["field"]: r["n_bad"] for r in quality.exception_fields(tickets, T.RULES).collect()}
    assert rows == TF.GOLDEN


def test_extended_rules(tickets):
    rows = {r["field"]: r["n_bad"] for r in quality.exception_fields(tickets, T.RULES, extended=True).collect()}
    for k, v in TF.GOLDEN_EXTENDED.items():
        assert rows[k] == v, k
    assert set(TF.GOLDEN) <= set(rows)


def test_valid_number_statistics(tickets):
    checked = quality.validate(tickets, T.RULES)
    r = checked.agg(F.count("告警触发次数").alias("n"), F.sum("告警触发次数").alias("s"),
                    F.min("告警触发次数").alias("lo"), F.max("告警触发次数").alias("hi"),
                    F.count("`日均流量(GB)`").alias("n2"), F.sum("`日均流量(GB)`").alias("s2")).first()
    assert (r["n"], r["s"], r["lo"], r["hi"], r["n2"]) == (44, 54.0, 1.0, 5.0, 7)
    assert abs(r["s2"] - 1.33) < 1e-9


def test_strict_numeric(spark):
    cases = [("", None), (" 1 ", 1.0), ("nan", None), ("inf", None), ("1d", None), ("1_0", None),
             ("1e3", 1000.0), ("-0.5", -0.5), (".5", 0.5), ("abc", None), ("+2", 2.0), ("1.", 1.0)]
    df = spark.createDataFrame([(t,) for t, _ in cases], "t string")
    got = dict((r["t"], r["v"]) for r in df.select("t", strict_double(F.col("t")).alias("v")).collect())
    assert got == dict(cases)


def test_range_bounds_inclusive(spark):
    rules = RuleSet((Range("x", 1, 500), OneOf("c", ("a", "b"))))
    df = spark.createDataFrame([("1", "a"), ("500", "b"), ("0.999", "c"), ("500.01", ""), ("250", "A")],
                               "x string, c string")
    out = [tuple(r) for r in quality.validate(df, rules).collect()]
    assert out == [(1.0, "a"), (500.0, "b"), (None, None), (None, None), (250.0, None)]


def test_fill_nulls_also_fills_nan(spark):
    df = spark.createDataFrame([(float("nan"), None), (None, "x"), (2.0, "y")], "v double, c string")
    out = [tuple(r) for r in quality.fill_nulls(df, {"v": 9.0, "c": "z"}).collect()]
    assert out == [(9.0, "z"), (9.0, "x"), (2.0, "y")]


def test_mode_ties_take_lowest_value_and_ignore_nulls(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), (None,), (None,)], "c string")
    r = stats.modes(df, ["c"]).first()
    assert (r["value"], r["n"]) == ("a", 2)


def test_fill_values_means_exclude_nulls(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, "a"), (3.0, None)], "v double, c string")
    assert stats.fill_values(df, ["v"], ["c"]) == {"v": 2.0, "c": "a"}


def test_batch_status_codes(spark, tickets):
    ok = quality.batch_status(tickets, T.RULES).first()
    assert (ok["status"], ok["n_rows"], ok["n_missing"]) == (0, 44, 0)
    empty = quality.batch_status(tickets.where(F.lit(False)), T.RULES).first()
    assert empty["status"] == quality.EMPTY
    short = quality.batch_status(tickets.drop("覆盖场景", "地市"), T.RULES).first()
    assert (short["status"], short["n_missing"]) == (quality.MISSING_COLUMNS, 2)
    assert quality.missing_columns(tickets.drop("地市").columns, T.RULES) == ["地市"]


def test_headers_of_many_files_stay_distributed(spark, tmp_dir):
    """Files of three layouts, one of them hot: distinct headers reach the
    driver, files and layouts are joined there where the lines are."""
    want = set()
    for i in range(90):
        header = [["a", "b"], ["b", "a"], ["a", "b", "b"]][i % 3]
        rows = [(f"{i}-{j}", str(j)) for j in range(200 if i == 4 else 2)]
        lines = [",".join(header)] + [",".join({"a": a, "b": b}[h] for h in header) for a, b in rows]
        write_lines(f"{tmp_dir}/d{i % 7}/f{i}.csv", lines + [",".join(header)])
        want |= {(a, b, b if len(header) == 3 else "") for a, b in rows}
    import unittest.mock as mock
    collected = []
    own = type(spark.range(0)).collect
    with mock.patch.object(type(spark.range(0)), "collect", lambda self: (collected.append(own(self)), collected[-1])[1]):
        table = src.read_delimited(spark, tmp_dir)
    assert [len(x) for x in collected] == [3]
    assert table.columns == ["a", "b", "b_2"] and {tuple(r) for r in table.collect()} == want
    assert src.read_ragged(spark, tmp_dir).count() == 0


def test_one_layout_needs_no_join(spark, tmp_dir):
    for i in range(3):
        write_lines(f"{tmp_dir}/f{i}.csv", ["a,b", f"{i},x", "a,b"])
    table = src.read_delimited(spark, tmp_dir)
    assert table.count() == 3
    assert "Exchange" not in table._jdf.queryExecution().executedPlan().toString()


def test_text_path_repeated_headers_trailing_blanks_short_rows(spark, tmp_dir):
    lines = ["a,b,c", "1,x,", "", "a,b,c", "2,,", "3", "4,y,z,extra", ""]
    path = write_lines(f"{tmp_dir}/t.csv", lines)
    df = src.read_delimited(spark, path)
    assert [tuple(r) for r in df.collect()] == [("1", "x", ""), ("2", "", "")]
    ragged = src.read_ragged(spark, path)
    assert sorted((r["value"], r["status"]) for r in ragged.collect()) == [
        ("3", quality.RAGGED), ("4,y,z,extra", quality.RAGGED)]
    fields = src.drop_repeated_headers(src.split_fields(src.scan_text(spark, path)), ["a", "b", "c"])
    table = src.all_string_table(fields.where(F.col("fields")[0] != ""), ["a", "b", "c"])
    assert [tuple(r) for r in table.collect()] == [("1", "x", ""), ("2", "", ""), ("3", "", ""), ("4", "y", "z")]


def test_every_file_is_read_by_its_own_header(spark, tmp_dir):
    """Moved columns, another first column, a missing one: matched by name."""
    write_lines(f"{tmp_dir}/in/a.csv", ["id,x,y", "1,10,20", "id,x,y", "2,11,21"])
    write_lines(f"{tmp_dir}/in/b.csv", ["id,y,x", "3,22,12"])
    write_lines(f"{tmp_dir}/in/sub/c.csv", ["y,id,x", "23,4,13", "24,5"])
    write_lines(f"{tmp_dir}/in/d [1].csv", ["id,x", "6,14"])
    write_lines(f"{tmp_dir}/in/e.csv", ["id,x,y"])
    out = src.read_delimited(spark, f"{tmp_dir}/in")
    assert sorted((r["id"], r["x"], r["y"]) for r in out.collect()) == [
        ("1", "10", "20"), ("2", "11", "21"), ("3", "12", "22"), ("4", "13", "23"), ("6", "14", "")]
    ragged = src.read_ragged(spark, f"{tmp_dir}/in").collect()
    assert [(r["value"], r["status"], r["source_path"].endswith("/sub/c.csv")) for r in ragged] == [("24,5", quality.RAGGED, True)]


def test_header_names_strip_bom(spark, tmp_dir):
    path = write_lines(f"{tmp_dir}/bom.csv", ["﻿id,v", "1,2"])
    assert src.header_names(spark, path) == ["id", "v"]


def test_positional_cast_and_contract(spark, tmp_dir):
    path = write_lines(f"{tmp_dir}/p.csv", ["a,b,c", "x,1.5,bad", "y,,3"])
    header = src.header_names(spark, path)
    fields = src.drop_repeated_headers(src.split_fields(src.scan_text(spark, path)), header)
    out = [tuple(r) for r in src.positional_cast(fields, header, (1, 2)).collect()]
    assert out == [("x", 1.5, None), ("y", None, 3.0)]
    schema = src.contract_schema("a", ["b"], ["c"])
    assert [f.dataType.simpleString() for f in schema.fields] == ["string", "double", "string"]


def test_rename_parentheses(spark):
    df = spark.createDataFrame([(1, 2)], "`日均流量(GB)` int, `问题归类(一级)` int")
    assert quality.rename_columns(df).columns == ["日均流量_GB", "问题归类_一级"]


def test_catalogue_shape():
    assert T.RULES.numeric == ("告警触发次数", "日均流量(GB)")
    assert len(T.RULES.categorical) == 16
    assert [len(T.RULES.rule(c).values) for c in T.RULES.categorical] == \
        [11, 91, 2, 4, 8, 17, 5, 2, 4, 2, 3, 2, 2, 15, 2, 40]
    assert len(T.CATALOGUE) == 33
    assert sum(not r.enforced for r in T.CATALOGUE) == 15
    assert T.TRAINING_ORDER[12:14] == T.RULES.numeric


def test_csv_inferred_reads_gbk(spark, tmp_dir):
    import os
    os.makedirs(f"{tmp_dir}/gbk")
    with open(f"{tmp_dir}/gbk/a.csv", "wb") as f:
        f.write("地市,告警触发次数\n杭州,3\n宁波,5\n".encode("gbk"))
    df = src.csv_inferred(spark, f"{tmp_dir}/gbk", encoding="GBK")
    assert df.columns == ["地市", "告警触发次数"]
    assert sorted(tuple(r) for r in df.collect()) == [("宁波", 5), ("杭州", 3)]


def test_crlf_lines_leave_no_carriage_return(spark, tmp_dir):
    import os
    os.makedirs(f"{tmp_dir}/crlf")
    lines = TF.ticket_lines()
    with open(f"{tmp_dir}/crlf/a.csv", "wb") as f:
        f.write(("\r\n".join(lines) + "\r\n").encode("utf-8"))
    header = lines[0].split(",")
    for df in (src.read_delimited(spark, f"{tmp_dir}/crlf"),
               src.read_csv_strings(spark, f"{tmp_dir}/crlf", header)):
        assert df.columns[-1] == header[-1] and df.count() == TF.N
        assert df.where(F.col(f"`{header[-1]}`").contains("\r")).count() == 0

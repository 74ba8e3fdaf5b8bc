"""One query per operator key, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables (or landing files Spark writes from
them under the shared scratch folder) over their whole extent. Computed
columns carry the same aliases as the SQL oracles in ``plans/oracle.py``.
Means are rounded to ``MEAN_DIGITS`` (7) places, model outputs to 9, so
engines that sum in a different order still agree (means of 2-decimal data
over these row counts never sit on a 7-place rounding tie).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from selfmend.functions.files import source_file_name, source_file_path
from selfmend.functions.numeric import strict_double
from selfmend.operators import attach, evaluation, features, model, quality, sinks, stats, vocabulary
from selfmend.plans import scoring, standins as S
from selfmend.session import path_exists, scratch_path
from selfmend.sources import delimited as src

Query = Callable[[SparkSession, str], DataFrame]
MEAN_DIGITS = 7
MAX_CATEGORIES = 1000    # vocabularies the feature queries fit on their own
REGISTRY: dict[str, Query] = {}


def query(key: str):
    def deco(fn: Query) -> Query:
        REGISTRY[key] = fn
        return fn
    return deco


# --------------------------------------------------------------- sources ---
def _orders_dir(spark, sf):
    return S.orders_text_dir(spark, sf)


_HEADERS: dict[str, list[str]] = {}


def _orders_text(spark, sf):
    """The orders landing text as an all-string table (S1-S5). The folder is
    written once per run and never changes, so its header line is read once."""
    path = _orders_dir(spark, sf)
    if path not in _HEADERS:
        _HEADERS[path] = src.header_names(spark, path)
    return src.read_delimited(spark, path, header=_HEADERS[path])


@query("src_text_scan")
def src_text_scan(spark, sf):
    """S1. Every line once: how many files hold the header line is up to the tasks that wrote them."""
    return src.scan_text(spark, _orders_dir(spark, sf)).distinct()


@query("src_split_fields")
def src_split_fields(spark, sf):
    f = src.split_fields(src.scan_text(spark, _orders_dir(spark, sf)))
    return f.select(F.col("fields")[0].alias("f_first"), F.size("fields").alias("n_fields"),
                    F.element_at("fields", -1).alias("f_last")).distinct()


@query("src_header_names")
def src_header_names(spark, sf):
    names = src.header_names(spark, _orders_dir(spark, sf))
    return spark.createDataFrame(list(enumerate(names)), "position int, name string")


@query("src_drop_repeated_headers")
def src_drop_repeated_headers(spark, sf):
    path = _orders_dir(spark, sf)
    header = src.header_names(spark, path)
    lines = src.scan_text(spark, path)
    return lines.where(F.split("value", ",", -1)[0] != F.lit(header[0]))


@query("src_all_string_table")
def src_all_string_table(spark, sf):
    return src.read_delimited(spark, _orders_dir(spark, sf))


@query("src_typed_table")
def src_typed_table(spark, sf):
    return src.typed_table(src.read_delimited(spark, _orders_dir(spark, sf)), ["o_totalprice"])


@query("src_positional_cast")
def src_positional_cast(spark, sf):
    path = _orders_dir(spark, sf)
    header = src.header_names(spark, path)
    fields = src.drop_repeated_headers(src.split_fields(src.scan_text(spark, path)), header)
    return src.positional_cast(fields, header, positions=(0, 1, 3))


@query("src_contract_schema")
def src_contract_schema(spark, sf):
    rules = S.ORDERS_RULES
    contract = src.contract_schema(rules.id, rules.numeric, rules.categorical)
    typed = src.typed_table(src.read_delimited(spark, _orders_dir(spark, sf)), rules.numeric)
    return typed.select(*contract.fieldNames()).to(contract)


@query("src_csv_inferred")
def src_csv_inferred(spark, sf):
    return src.csv_inferred(spark, _orders_dir(spark, sf))


@query("fn_strict_numeric")
def fn_strict_numeric(spark, sf):
    t = src.read_delimited(spark, _orders_dir(spark, sf))
    k = F.col("o_orderkey").cast("long")
    p = F.col("o_totalprice")
    spelled = (F.when(k % 17 == 0, F.lit("nan")).when(k % 19 == 0, F.lit("inf"))
               .when(k % 23 == 0, F.concat(p, F.lit("d")))
               .when(k % 29 == 0, F.regexp_replace(p, "[.]", "_"))
               .when(k % 3 == 0, F.concat(F.lit(" "), p, F.lit(" ")))
               .otherwise(p))
    return t.select(F.col("o_orderkey"), spelled.alias("text")) \
            .select("o_orderkey", "text", strict_double(F.col("text")).alias("number"))


@query("fn_source_file_name")
def fn_source_file_name(spark, sf):
    """The landed files' names: the parts that do not depend on the tasks that
    wrote them, the folder, and the data lines under each."""
    lines = src.scan_text(spark, _orders_dir(spark, sf)).select(
        "value", source_file_name().alias("f"), source_file_path().alias("path"))
    names = lines.where(~F.startswith("value", F.lit("o_orderkey,"))).select(
        F.regexp_extract("path", "/([^/]+)/[^/]+$", 1).alias("folder"), F.regexp_extract("f", "^([a-z]+)-[0-9]+-", 1).alias("prefix"),
        F.regexp_extract("f", r"\.([a-z]+)$", 1).alias("extension"),
        F.endswith("path", F.concat(F.lit("/"), F.col("f"))).alias("ends_path"))
    return names.groupBy("folder", "prefix", "extension", "ends_path").agg(F.count(F.lit(1)).alias("n_lines"))


# ----------------------------------------------------------- projections ---
@query("proj_required_columns")
def proj_required_columns(spark, sf):
    return quality.project_required(S.lineitem_raw(spark, sf), S.LINEITEM_RULES)


@query("proj_all_but_plus")
def proj_all_but_plus(spark, sf):
    li = S.lineitem_raw(spark, sf)
    return quality.project_all_but(li, S.LINEITEM_RULES.numeric,
                                   [(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("disc_price")])


@query("proj_rename_columns")
def proj_rename_columns(spark, sf):
    li = S.lineitem_raw(spark, sf).select("l_orderkey", "l_linenumber",
                                          F.col("l_extendedprice").alias("price(usd)"),
                                          F.col("l_tax").alias("tax(rate)"))
    return quality.rename_columns(li)


# ---------------------------------------------------------- data quality ---
def _three_inputs(spark, sf):
    full = _orders_text(spark, sf)
    return {"full": full, "empty": full.where(F.lit(False)), "short": full.drop("o_orderpriority")}


@query("dq_missing_columns")
def dq_missing_columns(spark, sf):
    short = _three_inputs(spark, sf)["short"]
    missing = quality.missing_columns(short.columns, S.ORDERS_RULES)
    return quality.batch_status(short, S.ORDERS_RULES).select(
        "n_rows", "n_missing", F.lit(",".join(missing)).alias("missing"), "status")


@query("dq_batch_status")
def dq_batch_status(spark, sf):
    out = None
    for name, df in _three_inputs(spark, sf).items():
        st = quality.batch_status(df, S.ORDERS_RULES).select(F.lit(name).alias("input"), "*")
        out = st if out is None else out.unionByName(st)
    return out


@query("dq_range_to_null")
def dq_range_to_null(spark, sf):
    li = S.lineitem_raw(spark, sf)
    types = dict((f.name, f.dataType) for f in li.schema.fields)
    return li.select("l_orderkey", "l_linenumber",
                     *[S.LINEITEM_RULES.rule(c).checked(types[c]) for c in S.LINEITEM_RULES.numeric])


@query("dq_enum_to_null")
def dq_enum_to_null(spark, sf):
    li = S.lineitem_raw(spark, sf)
    return li.select("l_orderkey", "l_linenumber",
                     *[S.LINEITEM_RULES.rule(c).checked() for c in S.LINEITEM_RULES.categorical])


@query("dq_validate_row")
def dq_validate_row(spark, sf):
    return quality.validate(S.lineitem_raw(spark, sf), S.LINEITEM_RULES)


def _lineitem_fill(spark, sf):
    rules = S.LINEITEM_RULES
    typed = quality.blanks_to_null(src.typed_table(S.lineitem_raw(spark, sf), rules.numeric),
                                   rules.categorical)
    return stats.fill_values(typed, rules.numeric, rules.categorical)


def _round_numeric(df, cols, digits=MEAN_DIGITS):
    return df.select(*[F.round(F.col(c), digits).alias(c) if c in cols else F.col(c) for c in df.columns])


@query("dq_fill_nulls")
def dq_fill_nulls(spark, sf):
    rules = S.LINEITEM_RULES
    checked = quality.validate(S.lineitem_raw(spark, sf), rules)
    return _round_numeric(quality.fill_nulls(checked, _lineitem_fill(spark, sf)), rules.numeric)


def _orders_training(spark, sf):
    return S.orders_training(_orders_text(spark, sf))


@query("dq_check_and_fill")
def dq_check_and_fill(spark, sf):
    rules = S.ORDERS_RULES
    train = scoring.prepare_training(_orders_training(spark, sf), S.ORDERS_SPEC)
    fill = stats.fill_values(train, rules.numeric, rules.categorical)
    text = _orders_text(spark, sf)
    return _round_numeric(quality.check_and_fill(text, rules, fill), rules.numeric)


@query("dq_extended_rules")
def dq_extended_rules(spark, sf):
    return quality.validate(S.lineitem_raw(spark, sf), S.LINEITEM_RULES, extended=True)


@query("dq_exception_fields")
def dq_exception_fields(spark, sf):
    return quality.exception_fields(S.lineitem_raw(spark, sf), S.LINEITEM_RULES, extended=True)


# ------------------------------------------------------------ statistics ---
@query("agg_batch_profile")
def agg_batch_profile(spark, sf):
    return quality.batch_profile(S.table(spark, sf, "lineitem"))


@query("agg_describe")
def agg_describe(spark, sf):
    d = stats.describe(S.table(spark, sf, "lineitem"), ["l_quantity", "l_discount", "l_tax"])
    return _round_numeric(d, ["mean", "stddev"])


@query("agg_numeric_mean")
def agg_numeric_mean(spark, sf):
    return _round_numeric(stats.numeric_means(S.table(spark, sf, "events"), ["value", "user_id"]),
                          ["value", "user_id"])


@query("agg_value_counts")
def agg_value_counts(spark, sf):
    return stats.value_counts(S.table(spark, sf, "documents"), ["lang", "source"])


@query("agg_mode")
def agg_mode(spark, sf):
    return stats.modes(S.table(spark, sf, "documents"), ["lang", "source"])


@query("agg_fill_values")
def agg_fill_values(spark, sf):
    rules = S.LINEITEM_RULES
    typed = quality.blanks_to_null(src.typed_table(S.lineitem_raw(spark, sf), rules.numeric),
                                   rules.categorical)
    return _round_numeric(stats.fill_values_frame(typed, rules.numeric, rules.categorical), ["num_value"])


@query("fit_minmax")
def fit_minmax(spark, sf):
    return stats.min_max(S.table(spark, sf, "lineitem"),
                         ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


# -------------------------------------------------------------- features ---
def _orders(spark, sf):
    return S.table(spark, sf, "orders")


def _index_frame(spark, idx_model, fields):
    rows = [(f, v, i) for f, labels in zip(fields, idx_model.labelsArray) for i, v in enumerate(labels)]
    return spark.createDataFrame(rows, "field string, value string, idx int")


@query("fit_string_index")
def fit_string_index(spark, sf):
    cols = ["o_orderpriority", "o_orderstatus"]
    text = quality.blanks_to_null(_orders_text(spark, sf), cols)
    return _index_frame(spark, features.fit_label_encoder(text, cols, MAX_CATEGORIES), cols)


@query("feat_label_encode_fit")
def feat_label_encode_fit(spark, sf):
    cols = ["o_orderpriority", "o_orderstatus"]
    o = _orders(spark, sf)
    return features.fit_label_encoder(o, cols, MAX_CATEGORIES).transform(o) \
        .select("o_orderkey", *[features.indexed(c) for c in cols])


@query("feat_large_vocabulary")
def feat_large_vocabulary(spark, sf):
    """A7 + F3/F4 with the vocabulary as a table: the parts and orders of the
    line items, far more values than a model may carry; learnt from half of
    the rows."""
    cols = ["l_partkey", "l_orderkey"]
    li = S.table(spark, sf, "lineitem").select(*cols, "l_linenumber")
    vocab = vocabulary.vocabulary_table(li.where(F.col("l_orderkey") % 2 == 0), cols)
    return vocabulary.index_by_join(li, vocab, cols, handle_invalid="keep")


@query("feat_label_encode_apply")
def feat_label_encode_apply(spark, sf):
    cols = ["o_orderpriority", "o_orderstatus"]
    o = _orders(spark, sf)
    train = o.where(F.col("o_orderstatus").isin(list(S.ORDERS_KNOWN_STATUSES)))
    m = features.fit_label_encoder(train, cols, MAX_CATEGORIES, handle_invalid="keep")
    return m.transform(o).select("o_orderkey", *[features.indexed(c) for c in cols])


@query("feat_label_index")
def feat_label_index(spark, sf):
    li = S.lineitem_labelled(spark, sf)
    features.check_vocabulary({S.LINEITEM_LABEL: li.select(S.LINEITEM_LABEL).distinct().count()}, MAX_CATEGORIES)
    return features.label_indexer(S.LINEITEM_LABEL).fit(li).transform(li) \
        .select("l_orderkey", "l_linenumber", features.LABEL)


@query("feat_assemble_numeric")
def feat_assemble_numeric(spark, sf):
    v = features.numeric_assembler(["o_totalprice", "o_custkey"]).transform(_orders(spark, sf))
    return features.vector_entries(v, "o_orderkey", features.NUM_VEC)


@query("feat_minmax_scale")
def feat_minmax_scale(spark, sf):
    v = features.numeric_assembler(["o_totalprice", "o_custkey"]).transform(_orders(spark, sf))
    scaled = features.minmax_scaler().fit(v).transform(v)
    return features.vector_entries(scaled, "o_orderkey", features.NUM_SCALED)


@query("feat_one_hot")
def feat_one_hot(spark, sf):
    cols = ["o_orderpriority", "o_orderstatus"]
    o = _orders(spark, sf)
    idx = features.fit_label_encoder(o, cols, MAX_CATEGORIES).transform(o)
    oh = features.one_hot_encoder(cols).fit(idx).transform(idx)
    return features.one_hot_entries(oh, "o_orderkey", cols)


@query("feat_assemble_all")
def feat_assemble_all(spark, sf):
    spec = S.ORDERS_SPEC
    o = _orders(spark, sf)
    features.fit_label_encoder(o, spec.categorical, spec.vocabulary_bound)     # refuses a vocabulary over the bound
    m = features.fit_features(o, spec.numeric, spec.categorical)
    return features.vector_entries(m.transform(o), "o_orderkey", features.FEATURES)


def _orders_feature_fit(spark, sf):
    """F8 on the training rows: typed + filled, then fit (label included)."""
    spec = S.ORDERS_SPEC
    train = _orders_training(spark, sf)
    fill, m = scoring.fit_features(train, spec, keep=["o_orderkey"])
    filled = quality.fill_nulls(scoring.prepare_training(train, spec, keep=["o_orderkey"]), fill)
    return filled, fill, m


@query("feat_pipeline_fit")
def feat_pipeline_fit(spark, sf):
    filled, _, m = _orders_feature_fit(spark, sf)
    out = features.apply_features(m, filled, keep=["o_orderkey"])
    return features.vector_entries(out, "o_orderkey", features.FEATURES, keep=[features.LABEL])


@query("feat_pipeline_apply")
def feat_pipeline_apply(spark, sf):
    spec = S.ORDERS_SPEC
    _, fill, m = _orders_feature_fit(spark, sf)
    text = _orders_text(spark, sf)
    checked = quality.fill_nulls(quality.validate(text, spec.rules), fill)
    return features.vector_entries(features.apply_features(m, checked, keep=["o_orderkey"]),
                                   "o_orderkey", features.FEATURES)


@query("feat_labeled_rows")
def feat_labeled_rows(spark, sf):
    spec = S.LINEITEM_EXACT_SPEC
    li = S.lineitem_labelled(spark, sf)
    features.fit_label_encoder(li, [*spec.categorical, spec.label], spec.vocabulary_bound)
    m = features.fit_features(li, spec.numeric, spec.categorical, spec.label)
    encoded = m.transform(li)
    out = encoded.select("l_orderkey", "l_linenumber", *features.labeled_rows(encoded).columns)
    return features.vector_entries(out, "l_orderkey", features.FEATURES, keep=["l_linenumber", features.LABEL])


# ----------------------------------------------------------------- model ---
_FITS: dict[tuple, scoring.Fitted] = {}


def _fitted(spark, sf, name, spec, train_fn) -> scoring.Fitted:
    key = (name, sf, spark.sparkContext.applicationId)
    if key not in _FITS:
        _FITS[key] = scoring.fit(train_fn(spark, sf), spec)
    return _FITS[key]


def _fitted_seeds(spark, sf, name, spec, train_fn, seeds) -> list[scoring.Fitted]:
    keys = [(f"{name}-{seed}", sf, spark.sparkContext.applicationId) for seed in seeds]
    if not all(key in _FITS for key in keys):
        _FITS.update(zip(keys, scoring.fit_seeds(train_fn(spark, sf), spec, seeds)))
    return [_FITS[key] for key in keys]


def _lineitem_exact(spark, sf):
    return _fitted(spark, sf, "lineitem-exact", S.LINEITEM_EXACT_SPEC, S.lineitem_labelled)


def _scored_lineitem(spark, sf, fitted=None):
    fitted = fitted or _lineitem_exact(spark, sf)
    return scoring.score(S.lineitem_labelled(spark, sf), S.LINEITEM_EXACT_SPEC, fitted)


@query("ml_forest_train")
def ml_forest_train(spark, sf):
    s = _scored_lineitem(spark, sf)
    return s.groupBy("l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.round("probability", 9)).alias("probability"),
        F.max("prediction").alias("prediction"))


@query("ml_forest_score")
def ml_forest_score(spark, sf):
    """M3: a hundred trees voting. Unbagged and over all features they are
    equal, so their average is known; ``ml_forest_configs`` has bagged ones."""
    fitted = _fitted(spark, sf, "lineitem-average", S.LINEITEM_AVERAGE_SPEC, S.lineitem_labelled)
    s = scoring.score(S.lineitem_labelled(spark, sf), S.LINEITEM_AVERAGE_SPEC, fitted)
    return s.select("l_orderkey", "l_linenumber", "prediction", "predictedLabel",
                    F.round("probability", 9).alias("probability"))


@query("ml_forest_configs")
def ml_forest_configs(spark, sf):
    """M1/M2: the two bagged configurations (seeds 10 and 20) trained on every
    row. What bagging does not change: the settings, the feature and class
    counts, and that every row's prediction is the class its trees favour."""
    li = S.lineitem_labelled(spark, sf)
    out, seeds = None, (10, 20)
    for seed, fitted in zip(seeds, _fitted_seeds(spark, sf, "lineitem-forest", S.LINEITEM_FOREST_SPEC, S.lineitem_labelled, seeds)):
        spec = replace(S.LINEITEM_FOREST_SPEC, seed=seed)
        forest = next(m for m in fitted.model.stages if hasattr(m, "trees"))
        scored = scoring.score(li, spec, fitted)
        favoured = F.when(F.col("probability") > 0.5, 1.0).when(F.col("probability") < 0.5, 0.0).otherwise(F.col("prediction"))
        one = scored.agg(F.count(F.lit(1)).alias("n_rows"),
                         F.count_if(F.col("probability").between(0, 1) & (F.col("prediction") == favoured)).alias("n_consistent"))
        one = one.select(F.lit(seed).alias("seed"), F.lit(forest.getNumTrees).alias("n_trees"), F.lit(forest.getMaxDepth()).alias("max_depth"),
                         F.lit(forest.getFeatureSubsetStrategy()).alias("subset"), F.lit(forest.getImpurity()).alias("impurity"),
                         F.lit(forest.numFeatures).alias("n_features"), F.lit(forest.numClasses).alias("n_classes"),
                         F.lit(max(t.depth for t in forest.trees) <= forest.getMaxDepth()).alias("within_depth"),
                         "n_rows", "n_consistent")
        out = one if out is None else out.unionByName(one)
    return out


@query("ml_probability")
def ml_probability(spark, sf):
    return _scored_lineitem(spark, sf).select("l_orderkey", "l_linenumber",
                                              F.round("probability", 9).alias("probability"))


@query("ml_label_decode")
def ml_label_decode(spark, sf):
    return _scored_lineitem(spark, sf).select("l_orderkey", "l_linenumber", "predictedLabel")


@query("eval_confusion_matrix")
def eval_confusion_matrix(spark, sf):
    spec = S.LINEITEM_EXACT_SPEC
    fitted = _lineitem_exact(spark, sf)
    train = quality.fill_nulls(scoring.prepare_training(S.lineitem_labelled(spark, sf), spec), fitted.fill)
    return model.confusion_matrix(fitted.model.transform(train))


def _held_out_lineitem(spark, sf):
    """The exact model trained on four fifths of the rows, and the others scored."""
    spec, held = S.LINEITEM_EXACT_SPEC, evaluation.held_out(["l_orderkey", "l_linenumber"], 0.2)
    fitted = _fitted(spark, sf, "lineitem-held-out", spec, lambda *a: S.lineitem_labelled(*a).where(~held))
    rows = quality.fill_nulls(scoring.prepare_training(S.lineitem_labelled(spark, sf).where(held), spec), fitted.fill)
    return fitted.model.transform(rows).select(features.LABEL, "prediction", model.probability_of(1).alias("probability"))


@query("eval_ranking")
def eval_ranking(spark, sf):
    """A9 on held-out rows: areas under the ROC and precision-recall curves."""
    out = evaluation.ranking(evaluation.score_histogram(_held_out_lineitem(spark, sf)))
    return out.select("n_positive", "n_negative", *[F.round(c, 9).alias(c) for c in ("roc_auc", "average_precision")])


@query("eval_per_class")
def eval_per_class(spark, sf):
    """A9 on held-out rows: precision, recall and F1 of each class."""
    out = evaluation.per_class(model.confusion_matrix(_held_out_lineitem(spark, sf)))
    return out.select("class", "n_rows", "n_predicted", "n_right", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")])


@query("ml_model_roundtrip")
def ml_model_roundtrip(spark, sf):
    path = scratch_path(spark, "model")
    _lineitem_exact(spark, sf).save(spark, path)
    loaded = scoring.Fitted.load(spark, path)
    return _scored_lineitem(spark, sf, loaded).select(
        "l_orderkey", "l_linenumber", "prediction", F.round("probability", 9).alias("probability"))


# ------------------------------------------------------------------ flow ---
def _orders_exact(spark, sf):
    return _fitted(spark, sf, "orders-exact", S.ORDERS_EXACT_SPEC, _orders_training)


@query("flow_score_batch")
def flow_score_batch(spark, sf):
    text = _orders_text(spark, sf)
    out = scoring.score(text, S.ORDERS_EXACT_SPEC, _orders_exact(spark, sf))
    return out.withColumn("probability", F.round("probability", 9))


@query("flow_append_prediction")
def flow_append_prediction(spark, sf):
    """The exact model's results next to the input row they came from."""
    text = _orders_text(spark, sf)
    out = scoring.score(text, S.ORDERS_EXACT_SPEC, _orders_exact(spark, sf))
    return out.withColumn("probability", F.round("probability", 9))


@query("flow_forest_score")
def flow_forest_score(spark, sf):
    """M7 with the reference forest (100 bagged trees): every input row, and
    whether its result is well formed (a known label, the favoured class)."""
    fitted = _fitted(spark, sf, "orders-forest", S.ORDERS_SPEC, _orders_training)
    out = scoring.score(_orders_text(spark, sf), S.ORDERS_SPEC, fitted)
    label = F.element_at(F.array(*[F.lit(x) for x in fitted.labels]), F.col("prediction").cast("int") + 1)
    p = F.col("probability")
    fits = ((p > 0.5) & (F.col("prediction") == 1)) | ((p < 0.5) & (F.col("prediction") == 0)) | (p == 0.5)
    return out.withColumn("well_formed", p.between(0, 1) & fits & (F.col("predictedLabel") == label)) \
        .drop("prediction", "predictedLabel", "probability")


@query("limit_preview")
def limit_preview(spark, sf):
    """L1: how many rows the preview shows, and how many of them are rows of
    the scored batch (which ones it shows is not defined)."""
    scored = flow_score_batch(spark, sf)
    shown = attach.preview(scored, 5)
    real = scored.withColumn("_real", F.lit(1)).distinct()
    found = shown.join(real.hint("merge"), [shown[c].eqNullSafe(real[c]) for c in shown.columns], "left")
    return found.agg(F.count(F.lit(1)).alias("n_shown"), F.count("_real").alias("n_in_batch"))


# ----------------------------------------------------------------- joins ---
@query("join_left_outer_result")
def join_left_outer_result(spark, sf):
    """The lineitem rows (``line_id`` shared by up to 6 rows) get the
    results scored from them, attached by row id -- one output row per input
    row, no pairs within an id."""
    raw = attach.with_row_ids(S.lineitem_raw(spark, sf))
    res = scoring.score(raw, S.LINEITEM_EXACT_SPEC, _lineitem_exact(spark, sf)) \
        .withColumn("probability", F.round("probability", 9))
    return attach.join_by_row_id(raw, res)


@query("join_project_result")
def join_project_result(spark, sf):
    """J2 on a unique id: every order text row once, plus its three results."""
    text = _orders_text(spark, sf)
    return attach.join_results(text, flow_score_batch(spark, sf), "o_orderkey")


# ----------------------------------------------------------------- sinks ---
def _events_schema(extra=(S.EVENTS_LABEL,)):
    return ", ".join(f"{c} string" for c in S.EVENTS_COLUMNS + tuple(extra))


@query("sink_delimited_text")
def sink_delimited_text(spark, sf):
    path = scratch_path(spark, "sink-text")
    ev = S.events_frame(spark, sf)
    sinks.write_delimited_text(ev, path, columns=ev.columns)
    return spark.read.text(path)


@query("sink_json")
def sink_json(spark, sf):
    path = scratch_path(spark, "sink-json")
    sinks.write_json(S.events_frame(spark, sf), path)
    return spark.read.schema(_events_schema()).json(path)


@query("sink_csv_header")
def sink_csv_header(spark, sf):
    path = scratch_path(spark, "sink-csv")
    ev = S.events_frame(spark, sf)
    sinks.write_csv_header(ev, path)
    return spark.read.schema(_events_schema()).option("header", True).csv(path).na.fill("")


@query("sink_parquet_time_cell")
def sink_parquet_time_cell(spark, sf):
    path = scratch_path(spark, "sink-parquet")
    sinks.write_time_cell_parquet(S.events_frame(spark, sf), path, "ts", "user_id", S.EVENTS_LABEL)
    return spark.read.parquet(path)


@query("sink_time_cell_judgement")
def sink_time_cell_judgement(spark, sf):
    """K4 on keys that repeat (hour, event type): one judgement each, ``low``
    before ``high``."""
    path = scratch_path(spark, "sink-judgement")
    ev = S.events_frame(spark, sf).withColumn("hour", F.substring("ts", 1, 13))
    sinks.write_time_cell_parquet(ev, path, "hour", "event_type", S.EVENTS_LABEL, precedence=("low", "high"))
    return spark.read.parquet(path)


@query("sink_single_file")
def sink_single_file(spark, sf):
    """K5 on a frame that is small by construction: the per-type summary (one
    row per event type) is computed distributed, then written as one file."""
    path = scratch_path(spark, "sink-single")
    summary = stats.value_counts(S.table(spark, sf, "events"), ["event_type"])
    sinks.write_csv_header(summary, path, n_files=1)
    back = spark.read.schema("field string, value string, n long").option("header", True).csv(path)
    n_files = back.select(F.col("_metadata.file_name")).distinct().count()
    return back.withColumn("n_files", F.lit(n_files))


def _events_landing(spark, sf):
    key = ("events-landing", sf, spark.sparkContext.applicationId)
    if key not in S._FIXTURES or not path_exists(spark, S._FIXTURES[key]):
        S._FIXTURES[key] = S.write_events_landing(spark, sf, scratch_path(spark, "events-landing"))
    return S._FIXTURES[key]


@query("sink_per_source_file")
def sink_per_source_file(spark, sf):
    """K6 over every landed file: files are read by their own headers --
    ``view`` files land without ``event_type``, which reads as blank -- and
    written with one output folder per source."""
    rows, columns = src.landed_rows(spark, _events_landing(spark, sf))
    df = rows.select(_kind(src.SOURCE).alias("source"), *[F.coalesce(c, F.lit("")).alias(name) for name, c in columns.items()])
    path = scratch_path(spark, "sink-per-source")
    sinks.write_json(df, path, partition_by="source")
    return spark.read.schema(_events_schema(("source",))).json(path) \
        .select(F.nullif("source", F.lit(NO_KIND)).alias("source"), "event_id", F.coalesce("event_type", F.lit("")).alias("event_type"))


# ------------------------------------------------------------- streaming ---
_RUNS: dict[tuple, dict] = {}


def _stream_run(spark, sf):
    """Land events as files, fit the events model, drain the landing folder
    once with the streaming job (availableNow) and return the output paths."""
    from selfmend.streaming import ServeConfig, serve
    key = (sf, spark.sparkContext.applicationId)
    if key in _RUNS and path_exists(spark, _RUNS[key]["root"]):
        return _RUNS[key]
    root = scratch_path(spark, "stream")
    landing = S.write_events_landing(spark, sf, f"{root}/landing")
    fitted = _fitted(spark, sf, "events-exact", S.EVENTS_EXACT_SPEC, S.events_training)
    cfg = ServeConfig(landing=landing, output=f"{root}/out", quarantine=f"{root}/quarantine",
                      metrics=f"{root}/metrics", checkpoint=f"{root}/checkpoint",
                      archive_dir=f"{root}/archive", processing_time=None)
    serve(spark, S.EVENTS_EXACT_SPEC, fitted, cfg).awaitTermination()
    run = {"root": root, "landing": landing, "cfg": cfg, "fitted": fitted}
    _RUNS[key] = run
    return run


NO_KIND = "__HIVE_DEFAULT_PARTITION__"      # the folder name of a NULL kind


def _kind(col="source_path"):
    return F.nullif(F.regexp_extract(F.col(col) if isinstance(col, str) else col, r"kind=([^/]+)/", 1), F.lit(NO_KIND))


def _archived_run(spark, sf):
    """The stream run, continued: a file is archived when a later batch starts,
    so one more (header-only) file lands and is drained; then the archive holds
    all that landed before it."""
    from selfmend.streaming import serve
    run = _stream_run(spark, sf)
    if "archived" not in run:
        S.write_closing_file(spark, sf, run["landing"])
        serve(spark, S.EVENTS_EXACT_SPEC, run["fitted"], run["cfg"]).awaitTermination()
        run["archived"] = True
    return run


@query("stream_landing_files")
def stream_landing_files(spark, sf):
    """S9 alone: the file stream's path column persisted by a file sink."""
    from selfmend.streaming import landing_stream
    root = scratch_path(spark, "landing-only")
    landing = S.write_events_landing(spark, sf, f"{root}/landing")
    q = (landing_stream(spark, landing).writeStream.format("parquet")
         .option("path", f"{root}/paths").option("checkpointLocation", f"{root}/ck")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    paths = spark.read.parquet(f"{root}/paths")
    return paths.select(_kind("path").alias("kind")).distinct()


@query("stream_score_files")
def stream_score_files(spark, sf):
    run = _stream_run(spark, sf)
    schema = (_events_schema(()) + ", source_file string, prediction double, "
              "predictedLabel string, probability double")
    out = spark.read.schema(schema).json(run["cfg"].output)
    return out.select("event_id", "event_type", "prediction", "predictedLabel",
                      F.round("probability", 9).alias("probability"))


@query("stream_repeated_headers")
def stream_repeated_headers(spark, sf):
    """S4 in T1: landed files with header lines inside. Per kind the rows
    counted and the rows scored or set aside: header lines are neither."""
    from selfmend.streaming import ServeConfig, serve
    root = scratch_path(spark, "stream-headers")
    landing = S.write_events_landing(spark, sf, f"{root}/landing", repeated_headers=True)
    fitted = _fitted(spark, sf, "events-exact", S.EVENTS_EXACT_SPEC, S.events_training)
    cfg = ServeConfig(landing=landing, output=f"{root}/out", quarantine=f"{root}/quarantine",
                      metrics=f"{root}/metrics", checkpoint=f"{root}/checkpoint", processing_time=None)
    serve(spark, S.EVENTS_EXACT_SPEC, fitted, cfg).awaitTermination()
    schema = "event_id string, source_path string"
    out = spark.read.schema(schema).json(cfg.output).select("source_path") \
        .unionByName(spark.read.schema(schema).json(cfg.quarantine).select("source_path"))
    counted = spark.read.parquet(cfg.metrics).select(_kind().alias("kind"), F.col("n_rows").alias("n_counted"))
    handed_on = out.select(_kind().alias("kind"), F.lit(0).cast("long").alias("n_counted"), F.lit(1).alias("n"))
    both = counted.withColumn("n", F.lit(0)).unionByName(handed_on)
    return both.groupBy("kind").agg(F.sum("n_counted").alias("n_counted"), F.sum("n").alias("n_handed_on"))


@query("stream_batch_metrics")
def stream_batch_metrics(spark, sf):
    m = spark.read.parquet(_stream_run(spark, sf)["cfg"].metrics)
    m = m.where(~F.contains("source_path", F.lit(f"kind={S.CLOSING_KIND}/")))
    return m.groupBy(_kind().alias("kind"), "status").agg(F.sum("n_rows").alias("n_rows"))


@query("stream_quarantine")
def stream_quarantine(spark, sf):
    q = spark.read.schema("event_id string, user_id string, status int") \
        .json(_stream_run(spark, sf)["cfg"].quarantine)
    return q.select("event_id", "user_id", "status")


@query("stream_archive_source")
def stream_archive_source(spark, sf):
    """The archive alone holds every data row that landed."""
    run = _archived_run(spark, sf)
    lines = (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv")
             .text(run["cfg"].archive_dir))
    kinds = lines.select(_kind("_metadata.file_path").alias("kind"), "value")
    return kinds.where(~F.col("value").startswith("event_id,")) \
        .groupBy("kind").agg(F.count(F.lit(1)).alias("n_rows"))


def queries() -> dict[str, Query]:
    return dict(REGISTRY)

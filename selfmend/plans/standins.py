"""Stand-in rule sets and landing-file fixtures over the driver's tables.

The ticket data itself is not available at scale, so every operator is
exercised on the TPC-H-like tables with a rule set of the same shape
(numeric ranges, enumerations, an id, a label). Blanks do not occur in those
tables, so they are injected by key (``key % 7 = 0`` etc.) -- every row is
kept, only some values are blanked.

Landing files are written under the session's shared scratch folder, split by
a fixed rule on the key (orders: even and odd keys) so that reading the folder
always meets repeated header lines; each task writes its own rows, the header
on the first line of every file, no quoting.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from selfmend.functions.numeric import fixed2_text
from selfmend.functions.rules import Free, OneOf, Range, RuleSet
from selfmend.plans.scoring import ScoringSpec
from selfmend.session import path_exists, scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- lineitem: ranges and enumerations, a duplicated id ---------------------
def line_id() -> Column:
    return F.concat_ws("-", F.col("l_orderkey").cast("string"),
                       F.col("l_linenumber").cast("string")).alias("line_id")


LINEITEM_RULES = RuleSet((
    Range("l_quantity", 5, 45),
    Range("l_discount", 0.01, 0.08),
    OneOf("l_returnflag", ("A", "N")),
    OneOf("l_linestatus", ("F", "O")),
    Range("l_tax", 0.0, 0.06, enforced=False),
    Range("l_extendedprice", 1000, 100000, enforced=False),
    Free("l_shipdate", enforced=False),
), id="line_id")


def lineitem_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as it would arrive: ``line_id`` = ``orderkey-linenumber`` (not
    unique in this data: the id join must attach each row its own result), quantity
    as text with blanks, return flag with blanks."""
    li = table(spark, sf_dir, "lineitem")
    k = F.col("l_orderkey")
    return li.select(
        line_id(),
        "l_orderkey", "l_linenumber",
        F.when(k % 7 == 0, F.lit("")).otherwise(F.col("l_quantity").cast("string")).alias("l_quantity"),
        "l_extendedprice", "l_discount", "l_tax",
        F.when(k % 11 == 0, F.lit("")).otherwise(F.col("l_returnflag")).alias("l_returnflag"),
        "l_linestatus", "l_shipdate")


# lineitem as a labelled set: is the quantity big for its line status?
# (class shares differ between the F and O groups, so a one-split tree is exact)
LINEITEM_LABEL = "size_band"
LINEITEM_EXACT_SPEC = ScoringSpec(RuleSet((OneOf("l_linestatus", ("F", "O")),)),
                                  LINEITEM_LABEL).exact(max_depth=2)
# A hundred equal trees: the forest's average is the one tree's share.
LINEITEM_AVERAGE_SPEC = replace(LINEITEM_EXACT_SPEC, num_trees=100)
LINEITEM_FOREST_SPEC = ScoringSpec(RuleSet((
    Range("l_discount", 0.0, 0.1), Range("l_tax", 0.0, 0.08),
    OneOf("l_returnflag", ("A", "N", "R")), OneOf("l_linestatus", ("F", "O")),
)), LINEITEM_LABEL)


def lineitem_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    limit = F.when(F.col("l_linestatus") == "F", F.lit(20)).otherwise(F.lit(30))
    return li.select(
        line_id(), "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_returnflag",
        "l_linestatus",
        F.when(F.col("l_quantity") > limit, F.lit("big")).otherwise(F.lit("small")).alias(LINEITEM_LABEL))


# --- orders: the flagship scoring stand-in ----------------------------------
ORDERS_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                  "o_orderpriority", "o_note")
ORDERS_RULES = RuleSet((
    Range("o_totalprice", 10000, 400000),
    OneOf("o_orderpriority", ("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW")),
    Free("o_orderdate", enforced=False),
), id="o_orderkey")
ORDERS_LABEL = "status_band"    # F, or any other status
ORDERS_SPEC = ScoringSpec(ORDERS_RULES, ORDERS_LABEL, max_categories=100)
# Exactly checkable variant: one binary category (rows outside the pair are
# invalid and filled with the mode), validated training, one unbagged tree.
# Spark merges sibling leaves that predict the same class, so with two groups
# the leaves are either the two groups or one pooled leaf -- both computable
# in SQL.
ORDERS_EXACT_SPEC = ScoringSpec(
    RuleSet((OneOf("o_orderpriority", ("1-URGENT", "4-NOT SPECIFIED")),), id="o_orderkey"),
    ORDERS_LABEL, validate_training=True).exact(max_depth=2)
# feat_label_encode_apply fits on these, so that a status is unseen when it applies.
ORDERS_KNOWN_STATUSES = ("F", "O")


def orders_training(text: DataFrame) -> DataFrame:
    """All orders, labelled: finished or not."""
    return text.withColumn(ORDERS_LABEL, F.when(F.col("o_orderstatus") == "F", F.lit("F")).otherwise(F.lit("rest")))


def orders_text_columns(orders: DataFrame) -> list[Column]:
    """Orders rendered as ticket-like text: price blank when key % 7 = 0,
    ``n/a`` when key % 13 = 0, two decimals otherwise; priority blank when
    key % 11 = 0; a trailing note field, blank unless key % 5 = 0."""
    k = F.col("o_orderkey")
    return [
        k.cast("string").alias("o_orderkey"),
        F.col("o_custkey").cast("string").alias("o_custkey"),
        F.col("o_orderstatus"),
        F.when(k % 7 == 0, F.lit("")).when(k % 13 == 0, F.lit("n/a"))
         .otherwise(fixed2_text("o_totalprice")).alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"),
        F.when(k % 11 == 0, F.lit("")).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
        F.when(k % 5 == 0, F.lit("rush")).otherwise(F.lit("")).alias("o_note"),
    ]


def write_landing_csv(df: DataFrame, path: str, partition_by: str) -> str:
    """Write ``df`` (string columns) as header-first, unquoted CSV files, a
    sub-folder per value of ``partition_by``."""
    (df.write.mode("overwrite").partitionBy(partition_by)
     .option("header", True).option("quote", "").option("escape", "")
     .option("emptyValue", "").option("nullValue", "").csv(path))
    return path


_FIXTURES: dict[tuple, str] = {}


def orders_text_dir(spark: SparkSession, sf_dir: str) -> str:
    """Landing folder with ``orders`` as ticket-like CSV text (cached per run)."""
    key = ("orders", sf_dir, spark.sparkContext.applicationId)
    if key not in _FIXTURES or not path_exists(spark, _FIXTURES[key]):
        orders = table(spark, sf_dir, "orders")
        text = orders.select(*orders_text_columns(orders), (F.col("o_orderkey") % 2).alias("half"))
        _FIXTURES[key] = write_landing_csv(text, scratch_path(spark, "orders-text"), "half")
    return _FIXTURES[key]


# --- events: stream stand-in -------------------------------------------------
EVENTS_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value", "props")
EVENTS_RULES = RuleSet((
    Range("value", 0.05, 300),
    OneOf("event_type", ("click", "view", "purchase", "signup")),
), id="event_id")
EVENTS_LABEL = "value_band"
EVENTS_EXACT_SPEC = ScoringSpec(
    RuleSet((OneOf("event_type", ("click", "purchase")),), id="event_id"),
    EVENTS_LABEL, validate_training=True).exact(max_depth=2)
SHORT_KIND = "view"      # files of this kind land without the ``event_type`` column
EMPTY_KIND = "none"      # one header-only file
CLOSING_KIND = "closing"  # a header-only file that lands after the others
SHORT_COLUMNS = tuple(c for c in EVENTS_COLUMNS if c != "event_type")


def events_text(events: DataFrame, extra=()) -> DataFrame:
    """Events as landing text; ``kind`` repeats the event type so it can
    also name the landing sub-folder."""
    return events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
        F.col("user_id").cast("string").alias("user_id"),
        "event_type",
        fixed2_text("value").alias("value"),
        "props",
        F.col("event_type").alias("kind"),
        *extra)


def value_band() -> Column:
    """The events label: ``high`` when the value exceeds its type's bar (20 for
    click/view, 80 otherwise), else ``low``."""
    bar = F.when(F.col("event_type").isin("click", "view"), F.lit(20)).otherwise(F.lit(80))
    return F.when(F.col("value") > bar, F.lit("high")).otherwise(F.lit("low")).alias(EVENTS_LABEL)


def events_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as landing text plus the label -- the frame the sinks write."""
    return events_text(table(spark, sf_dir, "events"), [value_band()]).drop("kind")


def events_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled events for fitting the stream's model."""
    return table(spark, sf_dir, "events").select("event_id", "event_type", "value", value_band())


def write_events_landing(spark: SparkSession, sf_dir: str, landing: str, repeated_headers: bool = False) -> str:
    """Events split into landing files, one sub-folder per kind: full files for
    most kinds, column-short files for ``SHORT_KIND``, one header-only file.
    With ``repeated_headers`` every seventh event is preceded or followed by a
    further header line, as in files put together from others."""
    text = events_text(table(spark, sf_dir, "events"))
    if repeated_headers:
        headers = text.where(F.col("event_id").cast("long") % 7 == 0).select(
            *[F.col(c) if c == "kind" else F.lit(c).alias(c) for c in text.columns])
        text = text.unionByName(headers).withColumn("_at", F.rand(7)).sortWithinPartitions("_at").drop("_at")
    is_short = F.coalesce(F.col("kind") == SHORT_KIND, F.lit(False))      # an unknown kind lands in full
    for part in (text.where(~is_short), text.where(is_short).drop("event_type")):
        (part.write.mode("append").partitionBy("kind")
         .option("header", True).option("quote", "").option("escape", "").option("emptyValue", "")
         .option("nullValue", "").csv(landing))
    _header_only(text, f"{landing}/kind={EMPTY_KIND}")
    return landing


def _header_only(text: DataFrame, path: str) -> None:
    text.where(F.lit(False)).drop("kind").coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_closing_file(spark: SparkSession, sf_dir: str, landing: str) -> None:
    """One more header-only file, of its own kind."""
    _header_only(events_text(table(spark, sf_dir, "events")), f"{landing}/kind={CLOSING_KIND}")

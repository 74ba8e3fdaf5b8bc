"""Quality rules with cross-document line frequency.

Per document a few counts (words, symbols, repeated lines and word windows)
and the base rule over them; then the method's verdict: lines are normalised
(lower case, white space collapsed, digits as 0) and hashed, and per host the
distinct documents that contain a line are counted. Lines in more documents
than the limits allow are removed: one in fifty and ten at least, since a line
that so many documents of a host share was not written for any one of them. A
document is depleted, and rejected, if it keeps less than ``min_left`` of its
words, or fewer words than the base rule asks of any document: its length was
boilerplate. Copies of one text count as one document, so a text is not called
boilerplate for being copied.

Everything about one document is an expression over its row. Counting is two
partial aggregates over digests. A host's frequent lines are at most the mean
lines of its documents divided by ``max_ratio``, so one row per host holds
them; documents take them by a join on the host, which Spark broadcasts if the
written table is small and splits by skew otherwise. A document meets its
host's list once, in a hashed intersection with its own lines.

Defined cases: a NULL or empty text has no words and fails the base rule; a
NULL host is a host of its own; repeated rows get a row each. A 3-word window
is told apart by a 64-bit hash within its own text. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from selfmend.llm.common import let, materialised, with_text

MAX_RATIO = 0.02
MIN_DOCUMENTS = 10
MIN_LEFT = 0.5
# fixed values of the base rule
MIN_WORDS = 50
MAX_REPEATED = 50       # per cent of the words
SYMBOLS = "#*$%&|<>"
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def _covered(hashes: Column) -> Column:
    """Words in windows whose hash occurs twice or more: the windows sorted by
    hash, those equal to a neighbour taken in order of their place; each adds
    the words that the one before did not cover."""
    placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeated(s: Column) -> Column:
        last = F.size(s) - 1
        twin = lambda x, j: (((j > 0) & (F.get(s, j - 1)["h"] == x["h"]))
                             | ((j < last) & (F.get(s, j + 1)["h"] == x["h"])))
        return F.sort_array(F.transform(F.filter(s, twin), lambda x: x["i"]))

    start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
    step = lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"))
    return F.aggregate(let(placed, repeated), start, step)["n"]


def repeated_words(found: Column) -> Column:
    """Words in 3-word windows that occur twice or more in ``found``."""
    windows = F.transform(F.sequence(F.lit(0), F.size(found) - 3),
                          lambda i: F.xxhash64(F.get(found, i), F.get(found, i + 1), F.get(found, i + 2)))
    counted = lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_covered(h))
    return F.when(F.size(found) < 4, F.lit(0)).otherwise(let(windows, counted))


def repeated_lines(text: Column) -> Column:
    filled = F.filter(F.split(text, "\n"), lambda x: F.regexp_like(x, F.lit(WORD)))
    return let(filled, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def normalised(line: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(F.regexp_replace(line, r"[ \t\f\r]+", " "))), "[0-9]+", "0")


def _marked() -> Column:
    """The lines of ``text`` in order: ``line`` and its digest ``d`` (NULL for a blank line)."""
    def mark(x: Column) -> Column:
        return let(normalised(x), lambda k: F.struct(x.alias("line"), F.when(k != "", F.md5(k.cast("binary"))).alias("d")))
    return F.transform(F.split("text", "\n"), mark)


def frequent_lines(docs: DataFrame, host: str, max_ratio: float = MAX_RATIO,
                   min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """``__host, __often``: of each host the digests of the lines above the limits."""
    own = docs.where(F.col("text").isNotNull()).select(
        F.col(host).alias("__host"), F.unhex(F.md5(F.col("text").cast("binary"))).alias("doc"), "text")
    digests = F.array_compact(F.array_distinct(F.transform(_marked(), lambda m: m["d"])))
    counted = (own.select("__host", "doc", F.explode(digests).alias("line"))
               .select("__host", "doc", F.unhex("line").alias("line")).distinct()
               .groupBy("__host", "line").agg(F.count("*").alias("n")).where(F.col("n") >= min_documents))
    total = (own.select("__host", "doc").distinct().groupBy("__host").agg(F.count("*").alias("total"))
             .select(F.col("__host").alias("__of"), "total"))
    often = materialised(counted, "line-counts").join(total, F.col("__host").eqNullSafe(F.col("__of")))
    return materialised(often.where(F.col("n") > max_ratio * F.col("total")).groupBy("__host")
                        .agg(F.collect_set(F.lower(F.hex("line"))).alias("__often")), "frequent-lines")


def _judged(docs: DataFrame, host: str, min_left: float, carried: Column, **limits) -> DataFrame:
    """``carried``, the base counts, ``base_failed``, ``kept`` and, as
    ``__left``, the text without the frequent lines."""
    often = frequent_lines(docs, host, **limits)
    name = "__carried"
    rows = docs.select(carried.alias(name), F.coalesce("text", F.lit("")).alias("text"), F.col(host).alias("__source"))
    rows = rows.join(often, F.col("__source").eqNullSafe(F.col("__host")), "left")

    def cut(lines: Column) -> Column:
        """The words in frequent lines, and the text without these lines."""
        found = F.array_intersect(F.transform(lines, lambda m: m["d"]), F.col("__often"))
        is_often = lambda hit, m: m["d"].isNotNull() & F.array_contains(hit, m["d"])
        return let(found, lambda hit: F.struct(
            F.aggregate(F.filter(lines, lambda m: is_often(hit, m)), F.lit(0), lambda a, m: a + F.size(words(m["line"]))).alias("removed"),
            F.array_join(F.transform(F.filter(lines, lambda m: ~is_often(hit, m)), lambda m: m["line"]), "\n").alias("left")))

    whole = F.struct(F.lit(0).alias("removed"), F.col("text").alias("left"))
    rows = rows.withColumn("__cut", F.when(F.col("__often").isNull(), whole).otherwise(let(_marked(), cut)))
    blanks = " \t\n\x0b\f\r"
    counts = rows.select(
        name,
        let(words(F.col("text")), lambda w: F.struct(F.size(w).alias("n"), repeated_words(w).alias("repeated"))).alias("w"),
        F.length(F.translate("text", blanks, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        repeated_lines(F.col("text")).cast("long").alias("n_dup_lines"),
        F.col("__cut.removed").cast("long").alias("n_removed_words"), F.col("__cut.left").alias("__left"))
    counts = counts.select(name, F.col("w.n").cast("long").alias("n_words"), "word_chars", "n_symbols",
                           "n_dup_lines", F.col("w.repeated").cast("long").alias("n_repeat_words"), "n_removed_words", "__left")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    left = F.col("n_words") - F.col("n_removed_words")
    enough = (left >= min_left * F.col("n_words")) & (left >= MIN_WORDS)
    return counts.withColumn("base_failed", failed).withColumn("kept", ~failed & enough)


def assess(docs: DataFrame, host: str, min_left: float = MIN_LEFT, **limits) -> DataFrame:
    """Per row: ``doc_id``, the base counts, ``base_failed``, the words in
    frequent lines and the verdict ``kept``."""
    return _judged(docs, host, min_left, F.col("doc_id"), **limits).drop("__left").withColumnRenamed("__carried", "doc_id")


def cleaned(docs: DataFrame, host: str, min_left: float = MIN_LEFT, **limits) -> DataFrame:
    """The rows of ``docs`` that ``assess`` keeps, without their frequent
    lines; columns unchanged."""
    names = docs.columns
    out = _judged(docs, host, min_left, F.struct(*[F.col(n) for n in names]), **limits).where("kept")
    return with_text(out.select("__carried.*", "__left"), F.col("__left")).select(*names)


ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, text IS NULL AS none, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, regexp_extract_all(text, '{WORD}') AS w FROM d),
g AS (SELECT r, unnest(range(1, len(w) - 1)) AS i, w FROM w WHERE len(w) >= 3),
gs AS (SELECT r, i, [w[i], w[i + 1], w[i + 2]] AS g FROM g),
gr AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM gs) WHERE c > 1),
rep AS (SELECT r, count(DISTINCT i + o) AS n FROM gr, (VALUES (0), (1), (2)) v(o) GROUP BY r),
l AS (SELECT r, source, none, text, unnest(string_split(text, chr(10))) AS line FROM d),
f AS (SELECT *, len(regexp_extract_all(line, '{WORD}')) AS nw,
        regexp_replace(lower(trim(regexp_replace(line, '[ \t\f\r]+', ' ', 'g'))), '[0-9]+', '0', 'g') AS k FROM l),
dl AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM f WHERE nw > 0 GROUP BY r),
n AS (SELECT source, k, count(DISTINCT text) AS n FROM f WHERE k <> '' AND NOT none GROUP BY source, k),
t AS (SELECT source, count(DISTINCT text) AS total FROM d WHERE NOT none GROUP BY source),
b AS (SELECT n.source, n.k FROM n JOIN t ON n.source IS NOT DISTINCT FROM t.source
      WHERE n.n >= {MIN_DOCUMENTS} AND n.n > CAST({MAX_RATIO} AS DOUBLE) * t.total),
rm AS (SELECT r, sum(nw) AS n FROM f JOIN b ON f.source IS NOT DISTINCT FROM b.source AND f.k = b.k GROUP BY r),
c AS (SELECT d.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(length(array_to_string(w.w, '')) AS BIGINT) AS word_chars,
        CAST(length(text) - length(translate(text, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols,
        CAST(coalesce(dl.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
        CAST(coalesce(rm.n, 0) AS BIGINT) AS n_removed_words
      FROM d JOIN w USING (r) LEFT JOIN rep USING (r) LEFT JOIN dl USING (r) LEFT JOIN rm USING (r)),
x AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed FROM c)
SELECT *, NOT base_failed AND n_words - n_removed_words >= CAST({MIN_LEFT} AS DOUBLE) * n_words
          AND n_words - n_removed_words >= {MIN_WORDS} AS kept FROM x
"""

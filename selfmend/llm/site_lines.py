"""Line dedup by site-relative frequency.

Per host, the number of pages that contain a line is divided by the host's
pages; lines on more than ``max_ratio`` of them (and on at least
``min_pages``) are boilerplate and dropped from every page of the host. One
page in a hundred: lines of a page's own content do not recur on that many
others of its host, while menus, notices and calls to subscribe that a site
puts on some of its pages do; five pages, so that on a host of less than 500
pages two or three quoting each other do not make a line boilerplate.
Lines are compared in lower case with white space collapsed. Copies of a text
are one page of their host in both counts, else a page that is copied often
enough would lose its whole text as boilerplate.

Near copies are different texts. With ``max_share`` a page of which more than
this share of the words would go is taken for one of a group of them: such
pages are left out of both counts, and what is boilerplate without them is
dropped from all pages, these too. A text that is copied with small changes,
however often, thus stays for near dedup to settle. A host on which all pages
are mostly boilerplate keeps it.

Counting is two partial aggregates over digests: (host, page, line), a line
listed once per row before the shuffle, then (host, line). The boilerplate lines of one host are at
most the mean lines of its pages divided by ``max_ratio``, whatever its number
of pages, so they fit into one row per host; the pages take them by a join on
the host that Spark broadcasts if the written table is small and splits by
skew otherwise. A page meets its host's list once, in a hashed intersection
with its own lines; each line is then looked up among the few found.

Defined cases: a NULL text stays NULL and is no page; a NULL host is a host
of its own; lines of white space alone are neither counted nor dropped; a
page whose lines are all dropped stays with an empty text; repeated rows and
copies count as one page and are cut alike, each in its row. Extra columns
pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from selfmend.llm.common import let, materialised, with_text

MAX_RATIO = 0.01
MIN_PAGES = 5


def normalised(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(line, r"[ \t\f\r]+", " ")))


def _marked() -> Column:
    """The lines of ``text`` in order: ``line``, its digest ``d`` (NULL for a
    blank line) and its words ``n``."""
    def mark(x: Column) -> Column:
        return let(normalised(x), lambda k: F.struct(
            x.alias("line"), F.when(k != "", F.md5(k.cast("binary"))).alias("d"),
            F.when(k != "", F.size(F.split(k, " "))).otherwise(0).alias("n")))
    return F.transform(F.split("text", "\n"), mark)


def _page_lines(own: DataFrame) -> DataFrame:
    """``__host, page, line``: each line of each distinct page once."""
    digests = F.array_compact(F.array_distinct(F.transform(_marked(), lambda m: m["d"])))
    return own.select("__host", "page", F.explode(digests).alias("line")) \
        .select("__host", "page", F.unhex("line").alias("line")).distinct()


def _n_pages(own: DataFrame, name: str) -> DataFrame:
    return own.select("__host", "page").distinct().groupBy("__host").agg(F.count("*").alias(name)) \
        .select(F.col("__host").alias("__of"), name)


def _lines_above(counted: DataFrame, total: DataFrame, max_ratio: float) -> DataFrame:
    often = counted.join(total, F.col("__host").eqNullSafe(F.col("__of")))
    return materialised(often.where(F.col("n") > max_ratio * F.col("total")).groupBy("__host")
                        .agg(F.collect_set(F.lower(F.hex("line"))).alias("__drop")), "boilerplate")


def _cut(use) -> Column:
    """``use(lines, gone)`` of the marked lines and, as a function of one of
    them, whether it is in ``__drop``."""
    def split(lines: Column) -> Column:
        found = F.array_intersect(F.transform(lines, lambda m: m["d"]), F.col("__drop"))
        return let(found, lambda hit: use(lines, lambda m: m["d"].isNotNull() & F.array_contains(hit, m["d"])))
    return let(_marked(), split)


def _share() -> Column:
    """The share of a page's words that stands in lines of ``__drop``."""
    def words(lines: Column, gone) -> Column:
        step = lambda a, m: F.struct((a["n"] + m["n"]).alias("n"), (a["gone"] + F.when(gone(m), m["n"]).otherwise(0)).alias("gone"))
        return F.aggregate(lines, F.struct(F.lit(0).alias("n"), F.lit(0).alias("gone")), step,
                           lambda a: F.when(a["n"] > 0, a["gone"] / a["n"]))
    return F.when(F.col("__drop").isNotNull(), _cut(words))


def boilerplate(pages: DataFrame, host: str, max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES,
                max_share: float | None = None) -> DataFrame:
    """``__host, __drop``: of each host with boilerplate the digests of its
    lines. With ``max_share``, pages that would lose more than this share of
    their words are taken as near copies of each other and left out of both
    counts."""
    own = pages.where(F.col("text").isNotNull()).select(
        F.col(host).alias("__host"), F.unhex(F.md5(F.col("text").cast("binary"))).alias("page"), "text")
    counted = materialised(_page_lines(own).groupBy("__host", "line").agg(F.count("*").alias("n"))
                           .where(F.col("n") >= min_pages), "line-counts")
    total = _n_pages(own, "total")
    drop = _lines_above(counted, total, max_ratio)
    if max_share is None:
        return drop
    copies = own.join(drop.withColumnRenamed("__host", "__at"), F.col("__host").eqNullSafe(F.col("__at"))) \
        .where(_share() > max_share).select("__host", "page", "text")
    copies = materialised(copies, "copied-pages")
    if copies.isEmpty():
        return drop
    # pages are counted once each, so what the copies added can be taken off again
    less = materialised(_page_lines(copies).groupBy(F.col("__host").alias("__at"), F.col("line").alias("__line"))
                        .agg(F.count("*").alias("less")), "copied-lines")
    counted = counted.join(less.hint("merge"), F.col("__host").eqNullSafe(F.col("__at")) & (F.col("line") == F.col("__line")), "left") \
        .select("__host", "line", (F.col("n") - F.coalesce("less", F.lit(0))).alias("n")).where(F.col("n") >= min_pages)
    fewer = _n_pages(copies, "less").withColumnRenamed("__of", "__at")
    total = total.join(fewer, F.col("__of").eqNullSafe(F.col("__at")), "left") \
        .select("__of", (F.col("total") - F.coalesce("less", F.lit(0))).alias("total"))
    return _lines_above(counted, total, max_ratio)


def _joined(pages: DataFrame, host: str, **limits) -> DataFrame:
    drop = boilerplate(pages, host, **limits)
    return pages.join(drop, F.col(host).eqNullSafe(F.col("__host")), "left").drop("__host")


def _kept_lines() -> Column:
    return _cut(lambda lines, gone: F.transform(F.filter(lines, lambda m: ~gone(m)), lambda m: m["line"]))


def drop_boilerplate(pages: DataFrame, host: str, **limits) -> DataFrame:
    """``pages`` without the boilerplate lines; columns unchanged."""
    names = pages.columns
    text = F.when(F.col("__drop").isNull(), F.col("text")).otherwise(F.array_join(_kept_lines(), "\n"))
    return with_text(_joined(pages, host, **limits), text).select(*names)


def report(pages: DataFrame, host: str, **limits) -> DataFrame:
    """Per row: ``doc_id``, its lines, how many were dropped, and the digest
    of the text that is left (NULL for a NULL text)."""
    cut = _joined(pages.select("doc_id", "text", host), host, **limits)
    lines = F.split("text", "\n")
    kept = F.when(F.col("__drop").isNull(), lines).otherwise(_kept_lines())
    counted = let(kept, lambda k: F.struct(F.size(lines).alias("before"), F.size(k).alias("after"),
                                           F.sha2(F.array_join(k, "\n").cast("binary"), 256).alias("sha")))
    null = F.col("text").isNull()
    return cut.select("doc_id", null.alias("null"), counted.alias("c")).select(
        "doc_id", F.when(F.col("null"), 0).otherwise(F.col("c.before")).cast("long").alias("n_lines"),
        F.when(F.col("null"), 0).otherwise(F.col("c.before") - F.col("c.after")).cast("long").alias("n_dropped"),
        F.when(~F.col("null"), F.col("c.sha")).alias("text_sha256"))


ORACLE = rf"""
WITH l AS (SELECT rowid_, doc_id, source, text, u.i AS i, u.line AS line,
             lower(trim(regexp_replace(u.line, '[ \t\f\r]+', ' ', 'g'))) AS k
           FROM (SELECT row_number() OVER () AS rowid_, * FROM documents) d,
             LATERAL (SELECT unnest(string_split(d.text, chr(10))) AS line,
                             generate_subscripts(string_split(d.text, chr(10)), 1) AS i) u
           WHERE d.text IS NOT NULL),
n AS (SELECT source, k, count(DISTINCT text) AS n FROM l WHERE k <> '' GROUP BY source, k),
t AS (SELECT source, count(DISTINCT text) AS total FROM documents WHERE text IS NOT NULL GROUP BY source),
b AS (SELECT n.source, n.k FROM n JOIN t ON n.source IS NOT DISTINCT FROM t.source
      WHERE n.n >= {MIN_PAGES} AND n.n > CAST({MAX_RATIO} AS DOUBLE) * t.total),
m AS (SELECT l.*, b.k IS NOT NULL AS dropped FROM l LEFT JOIN b ON l.source IS NOT DISTINCT FROM b.source AND l.k = b.k),
p AS (SELECT rowid_, doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
        coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '') AS kept FROM m GROUP BY rowid_, doc_id)
SELECT doc_id, n_lines, n_dropped, sha256(kept) AS text_sha256 FROM p
UNION ALL SELECT doc_id, 0, 0, NULL FROM documents WHERE text IS NULL
"""

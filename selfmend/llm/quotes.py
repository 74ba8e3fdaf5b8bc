"""Chat formatting: quotation linking.

A message's lines are read with their quote level (the ``>`` marks in front).
Lines of one level that follow each other are a passage. Quoted passages, and
the paragraphs and lines in them, are normalised (lower case, letters and
digits only) and hashed; they are joined to the equal passages, paragraphs or
lines of the unquoted text of earlier messages of the conversation. The
message that accounts for most quoted characters of a level is that level's
source; the source of the outermost resolved level is the message's parent.
Conversations come out in reply order: a thread is a message that answers
none, with all that answer it directly or indirectly; threads stand by the
turn of their first message, their messages by turn, so each reply follows
what it answers. A conversation without quotes keeps its order.

A quoted passage takes the latest earlier message that holds it: an as-of join
whose groups are cut into blocks of turns, so a phrase that everybody quotes,
or one conversation with a third of all messages, is spread over many tasks.
Threads are found by doubling the distance of each step up, a table in the
shared folder per step.

Defined cases: repeated rows are one message (``copies`` counts them);
messages of one turn do not quote each other and are ordered by role and text;
a NULL conversation or turn is never linked; a NULL text stays NULL; quoted
text that matches nothing is removed and left unlinked. Extra columns are not
read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from selfmend.llm.common import materialised

#: Turns in a block of the as-of join and of the numbering.
BLOCK_TURNS = 1000
_MARKS = r"^[ \t]*(?:>[ \t]*)*"
#: A line that announces a quote ("On ..., X wrote:").
_ANNOUNCEMENT = r"(?i)^[ \t]*(?:on .* wrote|am .* schrieb.*|le .* a écrit|el .* escribió)[ \t]*:[ \t]*$"
_OTHER = r"[^\p{L}\p{N}]+"


def _let(value: Column, use) -> Column:
    return F.transform(F.array(value), use)[0]


def _line(x: Column) -> Column:
    """Level and body of a line. White space in front of an unquoted line stays."""
    marks = F.regexp_extract(x, _MARKS, 0)
    level = F.length(marks) - F.length(F.replace(marks, F.lit(">"), F.lit("")))
    return F.struct(level.alias("level"), F.when(level > 0, F.substr(x, F.length(marks) + 1)).otherwise(x).alias("body"))


def passages(text: Column) -> Column:
    """The text's passages ``(level, body)`` in order."""
    def cut(lines: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(lines) - 1),
                          lambda i: (i == 0) | (F.get(lines, i)["level"] != F.get(lines, i - 1)["level"]))
        return _let(starts, lambda s: F.transform(s, lambda a, j: F.struct(
            F.get(lines, a)["level"].alias("level"),
            F.array_join(F.transform(F.slice(lines, a + 1, F.coalesce(F.get(s, j + 1), F.size(lines)) - a),
                                     lambda x: x["body"]), "\n").alias("body"))))

    return _let(F.transform(F.split(text, "\n"), _line), cut)


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), _OTHER, " "))


def units(body: Column) -> Column:
    """The normalised passage, its paragraphs and its lines, without empty ones."""
    every = F.concat(F.array(body), F.split(body, r"\n[ \t]*\n"), F.split(body, "\n"))
    return F.array_distinct(F.filter(F.transform(every, normalised), lambda x: x != ""))


def parsed(messages: DataFrame) -> DataFrame:
    """One row per distinct message: its identity ``mid``, ``text`` without
    quotes, the units of that, and the quoted units with their level."""
    key = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in ("conv_id", "turn", "role", "text")])
    rows = (messages.select("conv_id", "turn", "role", "text").groupBy("conv_id", "turn", "role", "text")
            .agg(F.count("*").alias("copies")).withColumn("mid", F.md5(key.cast("binary")))
            .withColumn("passages", passages(F.col("text"))))
    own = F.transform(F.filter("passages", lambda p: p["level"] == 0), lambda p: p["body"])
    kept = F.filter(F.split(F.array_join(own, "\n"), "\n"), lambda x: ~F.rlike(x, F.lit(_ANNOUNCEMENT)))
    quoted = F.transform(F.filter("passages", lambda p: p["level"] > 0), lambda p: F.transform(
        units(p["body"]), lambda u: F.struct(p["level"].alias("level"), u.alias("unit"))))
    has_quote = F.exists("passages", lambda p: p["level"] > 0)
    clean = F.when(has_quote, F.trim(F.array_join(kept, "\n"), F.lit(" \t\r\n"))).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", "role", "copies", "mid", clean.alias("text"),
                       F.transform(F.array_distinct(F.concat(units(F.array_join(kept, "\n")), F.flatten(F.transform(own, units)))),
                                   lambda u: F.unhex(F.md5(u.cast("binary")))).alias("own"),
                       F.array_distinct(F.flatten(quoted)).alias("quoted"))


def sources(rows: DataFrame) -> DataFrame:
    """``mid, level, src_turn, src_mid``: of each quoting message and level the
    earlier message that holds most of what is quoted."""
    known = rows.where(F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
    block = F.expr(f"floor(turn / {BLOCK_TURNS})")
    held = known.select("conv_id", F.explode("own").alias("unit"), "turn", "mid", block.alias("block"))
    asked = known.select("conv_id", F.explode("quoted").alias("q"), "turn", "mid", block.alias("block")) \
        .select("conv_id", F.unhex(F.md5(F.col("q.unit").cast("binary"))).alias("unit"), "turn", "mid", "block", "q.level",
                F.length("q.unit").cast("long").alias("weight"))
    # only units that somebody quotes take part
    wanted = asked.select("conv_id", "unit").distinct()
    held = materialised(held.join(wanted, ["conv_id", "unit"], "left_semi"), "held")
    latest = F.struct("turn", "mid")
    by_block = held.groupBy("conv_id", "unit", "block").agg(F.max(latest).alias("m"))
    asked_blocks = asked.select("conv_id", "unit", "block").distinct().withColumn("m", F.lit(None).cast("struct<turn:bigint,mid:string>"))
    order = Window.partitionBy("conv_id", "unit").orderBy("block")
    blocks = (by_block.unionByName(asked_blocks).groupBy("conv_id", "unit", "block").agg(F.max("m").alias("m"))
              .withColumn("before", F.max("m").over(order.rowsBetween(Window.unboundedPreceding, -1)))
              .where(F.col("before").isNotNull()).select("conv_id", "unit", "block", "before"))
    # within a block: what is held at an earlier turn
    nobody = F.lit(None).cast("struct<turn:bigint,mid:string>")
    events = held.select("conv_id", "unit", "block", "turn", "mid", F.lit(None).cast("int").alias("level"),
                         F.lit(None).cast("long").alias("weight"), latest.alias("src")) \
        .unionByName(asked.select("conv_id", "unit", "block", "turn", "mid", F.col("level").cast("int"), "weight", nobody.alias("src")))
    inside = Window.partitionBy("conv_id", "unit", "block").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    matched = (events.withColumn("src", F.max("src").over(inside)).where("level IS NOT NULL")
               .join(materialised(blocks, "blocks"), ["conv_id", "unit", "block"], "left")
               .withColumn("src", F.coalesce("src", "before")).where("src IS NOT NULL"))
    votes = matched.groupBy("mid", "level", "src").agg(F.sum("weight").alias("weight"))
    return votes.groupBy("mid", "level").agg(F.max(F.struct("weight", "src")).alias("s")) \
        .select("mid", "level", F.col("s.src.turn").alias("src_turn"), F.col("s.src.mid").alias("src_mid"))


def threads(parents: DataFrame) -> DataFrame:
    """``mid, root_turn, root_mid, depth`` of every message with a parent
    (``mid, src_turn, src_mid``)."""
    up = materialised(parents.select("mid", F.col("src_turn").alias("root_turn"), F.col("src_mid").alias("root_mid"),
                                     F.lit(1).cast("long").alias("depth")), "threads")
    while True:
        above = up.select(F.col("mid").alias("at"), F.col("root_turn").alias("t"), F.col("root_mid").alias("m"),
                          F.col("depth").alias("d"))
        step = materialised(up.join(above, F.col("root_mid") == F.col("at"), "left").select(
            "mid", F.coalesce("t", "root_turn").alias("root_turn"), F.coalesce("m", "root_mid").alias("root_mid"),
            (F.col("depth") + F.coalesce("d", F.lit(0))).alias("depth"), F.col("at").isNotNull().alias("moved")), "threads")
        up = step.drop("moved")
        if step.where("moved").isEmpty():
            return up


def conversations(messages: DataFrame) -> DataFrame:
    """Per message, ready to be read in the order ``conv_id, thread_turn,
    position``: the thread's first turn, the place in the thread, how many
    replies deep, the parent's turn, the resolved quotes as ``level:turn``,
    and the text without quotes."""
    rows = materialised(parsed(messages), "messages")
    found = materialised(sources(rows), "sources")
    parents = found.groupBy("mid").agg(
        F.min(F.struct("level", "src_turn", "src_mid")).alias("p"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("level", "src_turn"))),
                                 lambda x: F.concat_ws(":", x["level"].cast("string"), x["src_turn"].cast("string"))), ",").alias("quotes"))
    parents = materialised(parents.select("mid", "p.src_turn", "p.src_mid", "quotes"), "parents")
    placed = (rows.select("mid", "turn").join(parents, "mid", "left").join(threads(parents), "mid", "left")
              .withColumn("root_turn", F.coalesce("root_turn", "turn")).withColumn("root_mid", F.coalesce("root_mid", "mid"))
              .withColumn("block", F.expr(f"floor(turn / {BLOCK_TURNS})")))
    placed = materialised(placed, "placed")
    counts = placed.groupBy("root_mid", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("root_mid").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("root_mid", F.col("block").alias("of_block"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("root_mid", "block").orderBy("turn", "mid")
    numbered = placed.withColumn("row", F.row_number().over(inside) - 1)
    counts = materialised(counts.withColumnRenamed("root_mid", "of_root"), "counts")
    joined = numbered.join(counts, (F.col("root_mid") == F.col("of_root")) & F.col("block").eqNullSafe(F.col("of_block")))
    # the texts join last, once
    order = joined.select("mid", F.col("root_turn").alias("thread_turn"), (F.col("before") + F.col("row")).alias("position"),
                          F.coalesce("depth", F.lit(0)).cast("long").alias("reply_depth"),
                          F.col("src_turn").alias("parent_turn"), F.coalesce("quotes", F.lit("")).alias("quotes"))
    return rows.join(order, "mid").select("conv_id", "turn", "role", "copies", "thread_turn", "position", "reply_depth",
                                          "parent_turn", "quotes", "text")


ORACLE = rf"""
WITH RECURSIVE g AS (SELECT conv_id, turn, role, text, count(*) AS copies FROM conversations GROUP BY ALL),
m AS (SELECT *, md5(concat_ws(chr(31), coalesce(CAST(conv_id AS VARCHAR), chr(0)), coalesce(CAST(turn AS VARCHAR), chr(0)),
        coalesce(role, chr(0)), coalesce(text, chr(0)))) AS mid FROM g),
l0 AS (SELECT mid, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM m),
l1 AS (SELECT *, regexp_extract(line, '{_MARKS}') AS marks FROM l0),
l2 AS (SELECT mid, i, length(marks) - length(replace(marks, '>', '')) AS level, line, marks FROM l1),
l3 AS (SELECT mid, i, level, CASE WHEN level > 0 THEN substr(line, length(marks) + 1) ELSE line END AS body FROM l2),
l4 AS (SELECT *, CASE WHEN lag(level) OVER w IS DISTINCT FROM level THEN 1 ELSE 0 END AS s FROM l3 WINDOW w AS (PARTITION BY mid ORDER BY i)),
l5 AS (SELECT *, sum(s) OVER (PARTITION BY mid ORDER BY i) AS p FROM l4),
p AS (SELECT mid, p, level, string_agg(body, chr(10) ORDER BY i) AS body FROM l5 GROUP BY mid, p, level),
k AS (SELECT mid, string_agg(body, chr(10) ORDER BY i) AS kept FROM l3
      WHERE level = 0 AND NOT regexp_matches(body, '{_ANNOUNCEMENT}') GROUP BY mid),
q AS (SELECT mid, bool_or(level > 0) AS quoting FROM l3 GROUP BY mid),
b AS (SELECT mid, level, body FROM p UNION ALL SELECT mid, 0, kept FROM k),
u0 AS (SELECT mid, level, body AS u FROM b
       UNION ALL SELECT mid, level, unnest(regexp_split_to_array(body, '\n[ \t]*\n')) FROM b
       UNION ALL SELECT mid, level, unnest(string_split(body, chr(10))) FROM b),
u AS (SELECT DISTINCT mid, level, trim(regexp_replace(lower(u), '{_OTHER}', ' ', 'g')) AS u FROM u0),
x AS (SELECT u.*, m.conv_id, m.turn FROM u JOIN m USING (mid) WHERE u <> '' AND conv_id IS NOT NULL AND turn IS NOT NULL),
a AS (SELECT a.mid, a.level, a.u, max(struct_pack(turn := h.turn, mid := h.mid)) AS src
      FROM x a JOIN x h ON h.level = 0 AND a.level > 0 AND h.conv_id = a.conv_id AND h.u = a.u AND h.turn < a.turn
      GROUP BY a.mid, a.level, a.u),
v AS (SELECT mid, level, src, sum(length(u)) AS weight FROM a GROUP BY mid, level, src),
s AS (SELECT mid, level, max(struct_pack(weight := weight, src := src)) AS s FROM v GROUP BY mid, level),
par AS (SELECT mid, min(struct_pack(level := level, turn := s.src.turn, mid := s.src.mid)) AS p,
          string_agg(concat(level, ':', s.src.turn), ',' ORDER BY level) AS quotes FROM s GROUP BY mid),
up AS (SELECT mid, p.mid AS root, CAST(1 AS BIGINT) AS depth FROM par
       UNION ALL SELECT up.mid, par.p.mid, up.depth + 1 FROM up JOIN par ON par.mid = up.root),
top AS (SELECT mid, max(depth) AS depth, arg_max(root, depth) AS root FROM up GROUP BY mid),
z AS (SELECT m.*, coalesce(top.root, m.mid) AS root, coalesce(top.depth, 0) AS depth, par.p.turn AS parent_turn,
        coalesce(par.quotes, '') AS quotes, q.quoting, k.kept
      FROM m LEFT JOIN top USING (mid) LEFT JOIN par USING (mid) LEFT JOIN q USING (mid) LEFT JOIN k USING (mid))
SELECT z.conv_id, z.turn, z.role, z.copies, r.turn AS thread_turn,
  row_number() OVER (PARTITION BY z.root ORDER BY z.turn, z.mid) - 1 AS position, z.depth AS reply_depth, z.parent_turn, z.quotes,
  CASE WHEN z.quoting THEN coalesce(trim(z.kept, ' ' || chr(9) || chr(13) || chr(10)), '') ELSE z.text END AS text
FROM z JOIN m r ON r.mid = z.root
"""

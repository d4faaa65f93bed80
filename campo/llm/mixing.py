"""Mixing sources to target weights by weighted fair queueing.

Sources, by code point with null last, weigh 1, 2, 3, 1, 2, 3, ... and share
all words of the corpus; a target stops at ``MAX_PASSES`` times its source's
size and the excess goes to the others by weight.  Each source's documents are
shuffled by a hash of doc_id and queued up to ``MAX_PASSES`` times; a queued
copy's virtual finish time is the source's words up to its end over the
source's target.  All copies are sorted by finish time, and the mix is cut at
the total budget.  Copies are taken whole.

Null texts and texts without a word have size 0 and are never taken; a table
without words has targets of 0.  Rows that repeat are documents of their own.
Reruns give the same mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from campo.llm.common import partitions, running, select_rows, stage, text_hash, text_of

MAX_PASSES = 3
WORD = r"[^\x20\x09-\x0D]+"
SEED = ":mix"


def sized(docs: DataFrame) -> DataFrame:
    """Narrow rows: doc_id, source, size, the place in the shuffle (a hash of
    doc_id spread over all BIGINTs), text_hash."""
    digits = F.conv(F.substring(F.md5(F.concat(F.coalesce(docs["doc_id"].cast("string"), F.lit("")), F.lit(SEED))), 1, 15), 16, 10)
    return docs.select(docs["doc_id"].alias("doc_id"), docs["source"].cast("string").alias("source"),
                       F.regexp_count(text_of(docs), F.lit(WORD)).cast("long").alias("size"),
                       F.shiftleft(digits.cast("long") - (1 << 59), 4).alias("place"), text_hash(docs).alias("text_hash"))


def targets(sizes: DataFrame) -> DataFrame:
    """One row a source: source, rank, source_size, target.

    Sources by falling need of words (cap over weight, ascending) are capped
    until the level that is left suits the next one."""
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = by_source.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    w = ranked.select("*", (1 + (F.col("rank") - 1) % 3).cast("long").alias("weight"), (F.col("source_size") * MAX_PASSES).alias("cap"))
    every = Window.partitionBy(F.lit(0))
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("cap") / F.col("weight"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    level = ((F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0))).cast("double")
             / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    w = w.select("*", F.row_number().over(order).alias("pos"), level.alias("level"))
    w = w.withColumn("free", F.col("level") * F.col("weight") <= F.col("cap"))
    w = w.withColumn("at", F.min(F.when(F.col("free"), F.struct("pos", "level"))).over(every))
    return w.select("source", "rank", "source_size", F.when(
        F.col("at").isNull() | (F.col("pos") < F.col("at.pos")), F.col("cap").cast("double")).otherwise(F.col("at.level") * F.col("weight")).alias("target"))


def _finish(epoch):
    return (epoch * F.col("source_size") + F.col("before") + F.col("size")).cast("double") / F.col("target")


def mix(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, and
    source, copies, text_hash."""
    spark = docs.sparkSession
    sizes = stage(sized(docs), "mix-sizes")
    sources = stage(targets(sizes), "mix-targets").select(F.col("source").alias("_s"), "rank", "source_size", "target")
    total_rows = sizes.count()
    queue = running(sizes, ["source"], "place", ["doc_id", "size", "text_hash"], {"before": "size", "nth": "1"}, total=total_rows)
    queue = stage(queue.join(sources, queue["source"].eqNullSafe(F.col("_s"))).drop("_s"), "mix-queue")
    # a finish time by which the whole budget is surely queued
    stats = queue.groupBy("rank").agg(F.first("source_size").alias("s"), F.first("target").alias("t"), F.max("size").alias("m"))
    surely = [F.sum(F.greatest(F.lit(0.0), F.least(F.col("s") * float(MAX_PASSES), F.col("t") * float(2 ** k)) - F.col("m"))) for k in range(1, 41)]
    row = stats.agg(F.coalesce(F.sum("s"), F.lit(0)), *surely).first()
    budget = row[0]
    horizon = next((float(2 ** k) for k in range(1, 41) if (row[k] or 0) >= budget), float(2 ** 41))
    copies = queue.where("size > 0 and target > 0").withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(MAX_PASSES - 1))))
    copies = copies.select("rank", "nth", "pass", "size", _finish(F.col("pass")).alias("finish")).where(F.col("finish") <= horizon)
    copies = copies.select("*", F.lit(0).alias("all"), ((F.col("finish") / horizon - 0.5) * float(2 ** 63 - 2 ** 12)).cast("long").alias("time"))
    copies = running(copies, ["all"], "time", ["finish", "rank", "nth", "pass"], {"spent": "size"},
                     chunk=max(1, total_rows // (2 * partitions(spark))))
    last = copies.where(F.col("spent") + F.col("size") <= budget).agg(
        F.max(F.struct("finish", "rank", "nth", "pass")).alias("last")).first()["last"]
    if last is None:
        taken = F.lit(0)
    else:
        point = F.struct(F.lit(last["finish"]), F.lit(last["rank"]).cast("int"), F.lit(last["nth"]).cast("long"), F.lit(last["pass"]).cast("int"))
        taken = sum((F.when(F.struct(_finish(F.lit(k)), F.col("rank"), F.col("nth"), F.lit(k)) <= point, 1).otherwise(0)
                     for k in range(MAX_PASSES)), F.lit(0))
        taken = F.when((F.col("size") > 0) & (F.col("target") > 0), taken).otherwise(0)
    return queue.select("doc_id", "size", "source_size", "target", (taken * F.col("size")).cast("long").alias("taken"),
                        "source", taken.cast("int").alias("copies"), "text_hash")


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself: rows of ``docs``, as often as they are taken."""
    found = mix(docs).groupBy("doc_id", "text_hash").agg(F.sum("copies").alias("copies"))
    return select_rows(docs, found)


#: mix() in DuckDB SQL over a relation ``documents``
SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':mix'), 1, 15))::BIGINT AS place
  FROM documents),
by_source AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM by_source),
weighed AS (SELECT *, 1 + (rank - 1) % 3 AS weight, 3 * source_size AS cap FROM ranked),
levels AS (
  SELECT *, row_number() OVER o AS pos,
         (sum(source_size) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / (sum(weight) OVER () - coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS level
  FROM weighed WINDOW o AS (ORDER BY cap::DOUBLE / weight, rank)),
cut AS (SELECT arg_min(level, pos) AS level, min(pos) AS pos FROM levels WHERE level * weight <= cap),
targets AS (
  SELECT l.source, l.rank, l.source_size,
         CASE WHEN c.pos IS NULL OR l.pos < c.pos THEN l.cap::DOUBLE ELSE c.level * l.weight END AS target
  FROM levels l CROSS JOIN cut c),
queue AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, t.rank,
         coalesce(sum(s.size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         row_number() OVER w AS nth
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
  WINDOW w AS (PARTITION BY t.rank ORDER BY s.place, s.doc_id, s.size)),
copies AS (
  SELECT q.rank, q.nth, p.pass, q.size, (p.pass * q.source_size + q.before + q.size)::DOUBLE / q.target AS finish
  FROM queue q, (SELECT unnest([0, 1, 2]) AS pass) p WHERE q.size > 0 AND q.target > 0),
timed AS (
  SELECT *, sum(size) OVER (ORDER BY finish, rank, nth, pass ROWS UNBOUNDED PRECEDING) AS spent FROM copies),
kept AS (
  SELECT rank, nth, count(*) AS copies FROM timed
  WHERE spent <= (SELECT sum(size) FROM sized) GROUP BY rank, nth)
SELECT q.doc_id, q.size, q.source_size, q.target, (q.size * coalesce(k.copies, 0))::BIGINT AS taken
FROM queue q LEFT JOIN kept k ON q.rank = k.rank AND q.nth = k.nth
"""

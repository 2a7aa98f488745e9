"""Filter interaction audit: what every filter removes in every order of application, by source.

Five filters fail a document by five conditions, A to E, whose outcomes are five bits of a mask. Documents fold into mask
cells: by part and mask a number of documents, of good and of toxic ones, at most 32 rows a part. E, an equal text under a
smaller doc_id, is settled on digests: copies fold in the tasks that read them, so a text that a third of all rows have is
one row a task.

A recursive CTE enumerates the orders: a prefix of filters is extended by every letter that its applied bits lack, and carries
the masks along, so each level emits what its step does to each mask (keeps, removes, finds removed already). That is
(1 + 5 + 20 + 60 + 120 + 120) prefixes by 32 masks at most, whatever the table; it is broadcast to the cells. The metrics
of a step depend on the prefix only, so a full order takes them from its five prefixes.

Defined results: a null text is empty: it fails A (no words); a null source counts as the empty string; a text that stands
under a smaller doc_id fails E, rows without doc_id come after all others, and rows that share the smallest doc_id of a text
pass; of several labels of one doc_id any quality = 1 makes it good and any toxic = 1 toxic; rows that repeat count each;
other columns are not looked at; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm.common import order_id, read, words, written

FILTERS = "ABCDE"
BIT = {letter: 1 << i for i, letter in enumerate(FILTERS)}
LEAST_WORDS, DISTINCT_PERCENT, UPPER_PERCENT = 200, 50, 2
SYMBOLS = "[#$%&*|]"


def _texts(docs: DataFrame) -> DataFrame:
    """doc_id, id, part, digest and the mask of the conditions that a text settles by itself."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.alias("text"), words(text).alias("w"))
    size = F.size("w")
    upper = F.length("text") - F.length(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    fails = {
        "A": size < LEAST_WORDS, "B": 100 * F.size(F.array_distinct("w")) < DISTINCT_PERCENT * size,
        "C": 100 * upper > UPPER_PERCENT * F.length("text"), "D": F.col("text").rlike(SYMBOLS),
    }
    mask = sum((F.when(fail, BIT[letter]).otherwise(0) for letter, fail in fails.items()), F.lit(0))
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), order_id(F.col("doc_id")).alias("id"), "part", digest.alias("digest"), mask.alias("mask"))


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of equal id and text folded (n), with good and toxic added; rows without doc_id have no labels and are not joined."""
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = known.agg(F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    folded = rows.where("doc_id IS NOT NULL").groupBy("doc_id", "id", "part", "digest", "mask").agg(F.count("*").alias("n"))
    found = folded.join(known.where("good OR toxic"), "doc_id", "left")
    found = found.select("id", "part", "digest", "mask", "n", *(F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")))
    other = rows.where("doc_id IS NULL").groupBy("id", "part", "digest", "mask").agg(F.count("*").alias("n"))
    return found.union(other.select("*", F.lit(False).alias("good"), F.lit(False).alias("toxic")))


def mask_cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good and toxic: numbers of documents by part and set of conditions that they fail."""
    rows = _labelled(written(_texts(docs), "texts"), labels)
    kinds = ["digest", "part", "mask", "good", "toxic"]
    copies = written(rows.groupBy(*kinds).agg(F.sum("n").alias("n"), F.min(F.struct("id", "n")).alias("least")), "copies")
    first = copies.groupBy("digest").agg(F.min("least.id").alias("first"), F.count("*").alias("c")).where("c > 1").select("digest", "first")
    own = F.coalesce("first", "least.id") == F.col("least.id")
    passes = F.when(own, F.col("least.n")).otherwise(0)
    split = copies.join(first, "digest", "left").select("part", "good", "toxic", F.explode(F.array(
        F.struct(F.col("mask"), passes.alias("n")), F.struct(F.col("mask").bitwiseOR(BIT["E"]).alias("mask"), (F.col("n") - passes).alias("n"))
    )).alias("s"))
    count = lambda flag: F.sum(F.when(F.col(flag), F.col("s.n")).otherwise(0))
    cells = split.where("s.n > 0").groupBy("part", F.col("s.mask").alias("mask")).agg(F.sum("s.n").alias("n"), count("good").alias("good"), count("toxic").alias("toxic"))
    return written(cells, "cells")


def _orders(cells: DataFrame) -> DataFrame:
    """prefix, step, letter, mask and kept, removed, redundant, alone (0 or 1) of every prefix and mask that occurs."""
    letters = ", ".join(f"('{letter}', {bit})" for letter, bit in BIT.items())
    return cells.sparkSession.sql(f"""
        WITH RECURSIVE letters(letter, bit) AS (VALUES {letters}),
        orders(prefix, applied, step, letter, mask, kept, removed, redundant, alone) AS (
          SELECT CAST('' AS STRING), 0, 0, CAST('' AS STRING), mask, 1, 0, 0, 0 FROM (SELECT DISTINCT mask FROM {{cells}})
          UNION ALL
          SELECT concat(o.prefix, l.letter), o.applied | l.bit, o.step + 1, l.letter, o.mask,
                 IF((o.mask & (o.applied | l.bit)) = 0, 1, 0), IF((o.mask & l.bit) <> 0 AND (o.mask & o.applied) = 0, 1, 0),
                 IF((o.mask & l.bit) <> 0 AND (o.mask & o.applied) <> 0, 1, 0), IF(o.mask = l.bit, 1, 0)
          FROM orders AS o JOIN letters AS l ON (o.applied & l.bit) = 0
        )
        SELECT prefix, step, letter, mask, kept, removed, redundant, alone FROM orders WHERE step > 0""", cells=cells)  # fmt: skip


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, filter_order and step; `docs` has doc_id, text and source, `labels` doc_id, quality and toxic."""
    cells = mask_cells(docs, labels)
    orders = written(_orders(cells), "orders")  # 325 prefixes by 32 masks at most
    joined = cells.join(F.broadcast(orders), "mask")
    total = lambda flag, of="n": F.sum(F.col(flag) * F.col(of))
    steps = joined.groupBy("part", "prefix", "step", "letter").agg(
        total("kept").alias("kept"), total("removed").alias("removed"), total("redundant").alias("redundant"), total("alone").alias("unique_fails"),
        total("removed", "good").alias("good_lost"), total("removed", "toxic").alias("toxic_lost"),
    )
    steps = written(steps, "steps")
    left = len(FILTERS) - F.col("step")
    shapley = steps.groupBy("part", "letter").agg(F.sum(F.col("removed") * F.factorial(left.cast("int"))).alias("shapley"))  # orders that go on from a prefix
    full = orders.where(F.col("step") == len(FILTERS)).select(F.col("prefix").alias("filter_order")).distinct()
    taken = full.select("filter_order", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("k"))
    taken = taken.select("filter_order", F.substring("filter_order", F.lit(1), F.col("k")).alias("prefix"))  # 600 rows
    out = steps.join(F.broadcast(taken), "prefix").join(shapley, ["part", "letter"])
    numbers = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    return out.select("part", "filter_order", F.col("step").cast("int").alias("step"), *(F.col(c).cast("long").alias(c) for c in numbers))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(read(spark, sf_dir, "documents").select("doc_id", "text", "source"), read(spark, sf_dir, "labels"))


ORACLE = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), q AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         (len(w) < {LEAST_WORDS})::INT + 2 * (100 * len(list_distinct(w)) < {DISTINCT_PERCENT} * len(w))::INT
         + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > {UPPER_PERCENT} * length(text))::INT + 8 * regexp_matches(text, '{SYMBOLS}')::INT
         + 16 * (coalesce(doc_id, 9223372036854775807) > min(coalesce(doc_id, 9223372036854775807)) OVER (PARTITION BY text))::INT AS mask
  FROM w LEFT JOIN q USING (doc_id)
), c AS (
  SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL
), l AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS bit
), o AS (
  SELECT '' AS p UNION ALL SELECT p || letter FROM o JOIN l ON NOT contains(p, letter)
), s AS (
  SELECT full_order.p AS filter_order, k AS step, l.letter, l.bit,
         (SELECT coalesce(sum(x.bit), 0) FROM l AS x WHERE contains(substr(full_order.p, 1, k - 1), x.letter))::INT AS before
  FROM (SELECT p FROM o WHERE length(p) = 5) AS full_order, (SELECT unnest(range(1, 6)) AS k), l WHERE l.letter = substr(full_order.p, k, 1)
), m AS (
  SELECT part, filter_order, step, letter, sum(n) FILTER (mask & (before | bit) = 0) AS kept, sum(n) FILTER (mask & bit <> 0 AND mask & before = 0) AS removed,
         sum(n) FILTER (mask & bit <> 0 AND mask & before <> 0) AS redundant, sum(n) FILTER (mask = bit) AS unique_fails,
         sum(good) FILTER (mask & bit <> 0 AND mask & before = 0) AS good_lost, sum(toxic) FILTER (mask & bit <> 0 AND mask & before = 0) AS toxic_lost
  FROM c, s GROUP BY ALL
)
SELECT part, filter_order, step::INT AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
       coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       coalesce(sum(removed) OVER (PARTITION BY part, letter), 0)::BIGINT AS shapley
FROM m
"""

"""Line dedup: of lines that are equal, or differ by an edit of one word, the earliest stays.

Lines are compared as sequences of words, so white space does not tell them apart. A line goes if an equal line comes
earlier, or if both it and an earlier line have MIN_WORDS words or more and one word inserted, left out or replaced turns
one into the other. Earlier is by doc_id, then by place. Lines without words stay.

The deletion neighbourhood of a line is the line and all variants with one word left out: lines within one edit share a
variant. Equal lines fold into one before anything else. Three steps keep the neighbourhoods small without losing a pair:

1. An edit leaves the first half of a line or its last half untouched. Lines that share a half of fitting length with no
   other line have no partner and emit nothing.
2. All others emit every variant as a 128-bit code, the exclusive or of hashes of words with their places. Running sums
   over the words of a line give all its codes in one pass, also of lines of very many equal words. Codes that come up in
   one line only are of no use.
3. Lines with the same variant at the same place differ in the word left out there and nowhere else, so all but the
   earliest of them go; no pairs are built. A variant that is another whole line puts the two one insertion apart; again
   the earlier stays. Equal codes settle the edit.

Defined results: a null text is one empty line; rows without doc_id come last; rows that share a doc_id are ordered by a hash
of their text, and rows that are equal throughout are treated as one, so that both keep or lose the same lines; an empty
table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmill.llm.common import BLANKS, free_names, order_id, read, written

MIN_WORDS = 5
SEEDS = (0, 1)  # of the two halves of a variant's code
MOST_BROADCAST = 500_000  # places of lines, some 100 bytes each; more are joined by a shuffle
IRREGULAR_GAP = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"  # all gaps but a single space


def _plain(line: Column) -> Column:
    """A line's words with one space between them."""
    return F.regexp_replace(F.btrim(line, F.lit(BLANKS)), IRREGULAR_GAP, " ")


def _lines(rows: DataFrame) -> DataFrame:
    """All lines with words of (order, row, text): their place, number of words, two hashes and halves."""
    lines = rows.select("order", "row", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    lines = lines.select("order", "row", "line_no", _plain(F.col("line")).alias("line")).where("line <> ''")
    lines = lines.withColumn("n", F.octet_length("line") - F.octet_length(F.replace("line", F.lit(" "), F.lit(""))) + 1)
    return lines.select(
        "order", "row", "line_no", F.xxhash64("line").alias("ha"), F.crc32(F.col("line").cast("binary")).alias("hb"), _halves(F.col("line"), F.col("n")).alias("halves")
    )


def _halves(line: Column, n: Column) -> Column:
    """Codes of both halves, as the line may be the shorter or equal (t = n) or the longer one (t = n - 1) of a pair."""

    def of(t: Column) -> list[Column]:
        a = F.floor(t / 2).cast("int")
        first, last = F.call_function("substring_index", line, F.lit(" "), a), F.call_function("substring_index", line, F.lit(" "), a - t)
        return [F.xxhash64(F.lit("first"), t, first), F.xxhash64(F.lit("last"), t, last)]

    return F.when(n > MIN_WORDS, F.array(*of(n), *of(n - 1))).when(n == MIN_WORDS, F.array(*of(n)))


def _with_partners(distinct: DataFrame) -> DataFrame:
    """(ha, hb) of the lines that share a half with another line."""
    keys = distinct.where(F.col("halves").isNotNull()).select("ha", "hb", F.explode("halves").alias("half"))
    shared = keys.groupBy("half").agg(F.count("*").alias("c")).where("c > 1").select("half")
    return keys.join(shared, "half").select("ha", "hb").distinct()


def _code(seed: int, word: Column, place: Column) -> Column:
    return F.xxhash64(F.lit(seed), word, place)


def _whole(seed: int, words: Column) -> Column:
    """Code of a line with all its words."""
    codes = F.transform(words, lambda x, i: _code(seed, x, i))
    return F.aggregate(codes, F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(x))


def _variants(lines: DataFrame) -> DataFrame:
    """(ha, hb, at, k0, k1): the code of every variant of a line; at is the word left out, -1 for the whole line.

    Words before the one left out keep their place and those after it move up by one. Running sums give all codes of a line
    in one pass over its words, however many of them are equal.
    """
    line = Window.partitionBy("ha", "hb")
    so_far = line.orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    words = lines.select("ha", "hb", F.posexplode("w").alias("at", "word"))
    placed = words.select("ha", "hb", "at", *(_code(s, F.col("word"), F.col("at")).alias(f"c{s}") for s in SEEDS), *(_code(s, F.col("word"), F.col("at") - 1).alias(f"d{s}") for s in SEEDS))
    running = placed.select(
        "ha", "hb", "at", *(f"c{s}" for s in SEEDS), *(F.bit_xor(F.col(f"c{s}").bitwiseXOR(F.col(f"d{s}"))).over(so_far).alias(f"r{s}") for s in SEEDS),
        *(F.bit_xor(f"d{s}").over(line).alias(f"t{s}") for s in SEEDS),
    )
    shorter = running.select("ha", "hb", "at", *(F.col(f"r{s}").bitwiseXOR(F.col(f"c{s}")).bitwiseXOR(F.col(f"t{s}")).alias(f"k{s}") for s in SEEDS))
    whole = lines.select("ha", "hb", F.lit(-1).alias("at"), *(_whole(s, F.col("w")).alias(f"k{s}") for s in SEEDS))
    return shorter.union(whole)


def _later_neighbours(lines: DataFrame) -> DataFrame:
    """(ha, hb) of the lines that lie within one edit of an earlier line; `lines` has ha, hb, first and w."""
    variants = written(_variants(lines), "variants")
    repeated = variants.groupBy("k0").agg(F.min("ha").alias("low"), F.max("ha").alias("high")).where("low <> high").select("k0")
    found = written(variants.join(repeated, "k0").join(lines.select("ha", "hb", "first"), ["ha", "hb"]), "shared-variants")

    replaced = found.where("at >= 0")
    least = replaced.groupBy("k0", "k1", "at").agg(F.min("first").alias("least"), F.count("*").alias("c")).where("c > 1").drop("c")
    one = replaced.join(least, ["k0", "k1", "at"]).where("first > least").select("ha", "hb")
    whole = found.where("at < 0").select("k0", "k1", F.col("first").alias("whole_first"), F.col("ha").alias("whole_a"), F.col("hb").alias("whole_b"))
    inserted = replaced.join(whole, ["k0", "k1"])
    longer = inserted.where("whole_first < first").select("ha", "hb")
    shorter = inserted.where("first < whole_first").select(F.col("whole_a").alias("ha"), F.col("whole_b").alias("hb"))
    return one.union(longer).union(shorter).distinct()


def repeated_lines(rows: DataFrame) -> DataFrame:
    """(row, gone): numbers of the lines that go, from 0, for the rows that lose any; `rows` has order, row and text."""
    lines = written(_lines(rows), "lines")
    place = F.struct("order", "row", "line_no")
    distinct = lines.select("ha", "hb", place.alias("first"), "halves")
    distinct = distinct.groupBy("ha", "hb").agg(F.min("first").alias("first"), F.first("halves").alias("halves"), F.count("*").alias("c"))
    distinct = written(distinct, "distinct-lines")
    partners = written(_with_partners(distinct).join(distinct.select("ha", "hb", "first"), ["ha", "hb"]), "partners")
    # Words of the partners, from the places that have them first.
    wanted = partners.select("ha", "hb", "first", F.col("first.row").alias("row"), F.col("first.line_no").alias("line_no"))
    wanted = F.broadcast(wanted) if partners.count() <= MOST_BROADCAST else wanted
    texts = rows.select("row", F.posexplode(F.split("text", "\n")).alias("line_no", "line")).join(wanted, ["row", "line_no"])
    texts = texts.select("ha", "hb", "first", F.split(_plain(F.col("line")), " ").alias("w")).dropDuplicates(["ha", "hb"])
    near = written(_later_neighbours(written(texts, "partner-words")), "near").withColumn("near", F.lit(True))

    known = distinct.select("ha", "hb", "first", "c").join(near, ["ha", "hb"], "left").where("c > 1 OR near")
    gone = lines.select("row", place.alias("place"), "ha", "hb").join(known, ["ha", "hb"]).where("near OR place > first")
    return gone.groupBy("row").agg(F.array_sort(F.collect_set("place.line_no")).alias("gone"))


def identified(docs: DataFrame, text: str, doc_id: str) -> tuple[Column, Column]:
    """Columns `order` and `row`: what orders documents, and what tells them apart."""
    identity = F.col(doc_id).cast("long")
    ids = docs.select(identity.alias("id")).groupBy("id").count()
    unique = ids.where("id IS NULL OR count > 1").isEmpty()
    order = order_id(F.col(doc_id))
    return order, order if unique else F.xxhash64(identity, F.coalesce(F.col(text), F.lit("")))


def _rows(docs: DataFrame, text: str, doc_id: str) -> tuple[DataFrame, Column]:
    order, row = identified(docs, text, doc_id)
    return docs.select(order.alias("order"), row.alias("row"), F.coalesce(F.col(text), F.lit("")).alias("text")), row


def without_repeated_lines(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """`docs` with the lines that stay, and the columns n_lines and n_removed, which replace any of these names.

    All rows and all other columns stay.
    """
    rows, row = _rows(docs, text, doc_id)
    gone = repeated_lines(rows)
    others = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    key, own, lost = free_names(docs.columns, "_row", "_gone", "_lost")
    joined = docs.select(*(F.col(f"`{c}`") for c in others), row.alias(key)).join(gone.select(F.col("row").alias(key), F.col("gone").alias(own)), key, "left")
    lines = F.split(F.coalesce(F.col(text), F.lit("")), "\n")
    joined = joined.withColumn(lost, F.map_from_entries(F.transform(own, lambda i: F.struct(i, F.lit(True)))))
    kept = F.array_join(F.filter(lines, lambda _, i: F.try_element_at(F.col(lost), i).isNull()), "\n")
    joined = joined.withColumns({"n_lines": F.size(lines), "n_removed": F.coalesce(F.size(own), F.lit(0))})
    joined = joined.withColumn(text, F.when(F.col(own).isNull(), F.col(text)).otherwise(kept))
    return joined.select(*(F.col(f"`{c}`") for c in others), "n_lines", "n_removed")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, number of lines, and which of them go, counted from 0."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    rows, row = _rows(docs, "text", "doc_id")
    gone = repeated_lines(rows)
    counted = docs.select("doc_id", row.alias("row"), F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long").alias("n_lines"))
    out = counted.join(gone, "row", "left")
    return out.select("doc_id", "n_lines", F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"), F.coalesce(F.array_join("gone", ","), F.lit("")).alias("removed"))


ORACLE = rf"""
WITH l AS (
  SELECT doc_id, i - 1 AS line_no, list_filter(string_split_regex(ls[i], '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents), unnest(range(1, len(ls) + 1)) AS u(i)
), d AS (
  SELECT w, len(w) AS n, min((doc_id, line_no)) AS first FROM l WHERE len(w) > 0 GROUP BY w
), v AS (
  SELECT w, first, p, list_concat(list_slice(w, 1, p - 1), list_slice(w, p + 1, n)) AS r FROM d, unnest(range(1, n + 1)) AS u(p) WHERE n >= {MIN_WORDS}
), s AS (
  SELECT w FROM (SELECT w, first, min(first) OVER (PARTITION BY md5(array_to_string(r, ' ')), p) AS least FROM v) WHERE first > least
), pairs AS (
  SELECT v.w AS long_w, v.first AS long_first, d.w AS short_w, d.first AS short_first FROM v JOIN d ON d.w = v.r AND d.n >= {MIN_WORDS}
), near AS (
  SELECT w FROM s UNION SELECT long_w FROM pairs WHERE short_first < long_first UNION SELECT short_w FROM pairs WHERE long_first < short_first
), gone AS (
  SELECT doc_id, list(line_no ORDER BY line_no) AS g FROM l JOIN d USING (w)
  WHERE (doc_id, line_no) > first OR w IN (SELECT w FROM near) GROUP BY doc_id
)
SELECT doc_id, len(string_split(coalesce(text, ''), chr(10)))::BIGINT AS n_lines, coalesce(len(g), 0)::BIGINT AS n_removed,
       coalesce(array_to_string(g, ','), '') AS removed
FROM documents LEFT JOIN gone USING (doc_id)
"""

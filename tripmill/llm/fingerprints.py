"""Document fingerprints by order min hash.

The k-mers of a text are runs of K words, numbered by their occurrence, so that the third "a b" is another element than the
first. A random rank of k-mer and number deals the elements into 2 ** bits bins; of each bin the TUPLE elements of least rank are
taken, put back in text order, and their k-mers hashed to one component. Two texts agree in a component if the same k-mers
were selected and stand in the same order, so likeness falls with the edit distance and not only with the vocabulary.

All is built-in array functions on the rows where the texts are: no shuffle, no Python. One 31-bit rank and one 32-bit
place share a long, so that both orders are plain sorts of longs.

The next document by doc_id comes by a window over ranges of doc_id, at most MOST_RANGES of them, whose bounds are quantiles
of a sample of at most SAMPLED keys a range; the first documents of ranges are joined to the last ones of the ranges before.

Defined results: null and empty texts have no components, and are wholly like each other; a text of fewer than K words has
its whole sequence as the only k-mer; documents of equal doc_id follow in the order of a hash of their texts (ties: the texts), and those without doc_id
come last; a lone document is its own next; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmill.llm.common import order_id, read, words

K = 2
BIN_BITS = 7  # half-equal texts share one component in nine, and all of 128 hardly ever miss
TUPLE = 2
RANGE_ROWS, MOST_RANGES, SAMPLED = 256, 16384, 8

LOW31, LOW32 = 0x7FFFFFFF, 0xFFFFFFFF


def _low(value: Column, mask: int) -> Column:
    return value.bitwiseAND(F.lit(mask).cast("long"))


def _packed(rank: Column, place: Column) -> Column:
    return F.shiftleft(_low(rank, LOW31), 32).bitwiseOR(place.cast("long"))


def _kmer(own: Column, place: Column) -> Column:
    """Code of the k-mer at a place; words past the end count as none."""
    return F.xxhash64(*(F.get(own, place + i if i else place) for i in range(K)))


def _starts(values: Column, bits: int) -> Column:
    """Places of a sorted array where the bits above `bits` change."""
    differs = lambda i: F.shiftright(F.get(values, i), bits) != F.shiftright(F.get(values, i - 1), bits)
    places = F.when(F.size(values) > 0, F.sequence(F.lit(0), F.size(values) - 1)).otherwise(F.array().cast("array<int>"))
    return F.filter(places, lambda i: (i == 0) | differs(i))


def with_fingerprint(rows: DataFrame, text: str, name: str, bits: int = BIN_BITS) -> DataFrame:
    """Adds the components of `text`, an array of 2 ** bits longs with nulls for bins without elements.

    Each step is a column of its own that the next uses more than once, which keeps Spark from working it out anew for
    every element.
    """
    rows = rows.withColumn("_w", words(F.col(text)))
    own = F.col("_w")
    at_all = F.slice(own, 1, F.greatest(F.size(own) - (K - 1), F.least(F.size(own), F.lit(1))))
    rows = rows.withColumn("_k", F.sort_array(F.transform(at_all, lambda _, i: _packed(_kmer(own, i), i))))
    rows = rows.withColumn("_s", _starts(F.col("_k"), 32))
    sorted_k, starts = F.col("_k"), F.col("_s")
    run = lambda s, g: F.slice(sorted_k, s + 1, F.coalesce(F.get(starts, g + 1), F.size(sorted_k)) - s)
    ranked = lambda x, o: _packed(F.xxhash64(F.shiftright(x, 32), o), _low(x, LOW32))
    rows = rows.withColumn("_r", F.sort_array(F.flatten(F.transform(starts, lambda s, g: F.transform(run(s, g), ranked)))))
    bin_bits = 63 - bits
    rows = rows.withColumn("_b", _starts(F.col("_r"), bin_bits))
    sorted_r = F.col("_r")

    def component(s: Column) -> Column:
        bin_ = F.shiftright(F.get(sorted_r, s), bin_bits)
        chosen = F.filter(F.slice(sorted_r, s + 1, TUPLE), lambda z: F.shiftright(z, bin_bits) == bin_)
        places = F.sort_array(F.transform(chosen, lambda z: _low(z, LOW32).cast("int")))
        return F.struct(bin_.cast("int").alias("bin"), F.xxhash64(F.transform(places, lambda p: _kmer(own, p))).alias("code"))

    rows = rows.withColumn("_c", F.map_from_entries(F.transform(F.col("_b"), component)))
    found = F.col("_c")
    rows = rows.withColumn(name, F.array(*(F.try_element_at(found, F.lit(b)) for b in range(1 << bits))))
    return rows.drop("_w", "_k", "_s", "_r", "_b", "_c")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal components among those that either text has; 1 if neither has any."""
    pairs = F.zip_with(a, b, lambda x, y: F.when(x.isNotNull() | y.isNotNull(), F.coalesce((x == y).cast("int"), F.lit(0))))
    some = F.filter(pairs, lambda p: p.isNotNull())
    return F.when(F.size(some) == 0, F.lit(1.0)).otherwise(F.aggregate(some, F.lit(0), lambda n, p: n + p) / F.greatest(F.size(some), F.lit(1)))


def shown(components: Column) -> Column:
    """Components as a string, 16 hexadecimal digits or dashes each."""
    return F.array_join(F.transform(components, lambda c: F.coalesce(F.lower(F.lpad(F.hex(c), 16, "0")), F.lit("-" * 16))), "")


def _ranged(rows: DataFrame, order: str, text: str, range_rows: int | None = None) -> DataFrame:
    """Adds `_range`, which grows with (order, hash of the text), and `_hash`.

    Bounds are quantiles of a sample of keys, so ranges hold like numbers of rows however ids lie. A key has a third part, a
    hash of the row's place, so that rows of equal id, and even equal rows, are dealt to several ranges where they are many.
    """
    key = F.struct(F.col(order).alias("o"), F.col("_hash").alias("h"), F.col("_tie").alias("t"))
    keyed = rows.withColumn("_hash", F.xxhash64(text)).withColumn("_tie", F.xxhash64(F.monotonically_increasing_id()))
    n = rows.count()
    ranges = max(1, min(MOST_RANGES, n // (range_rows or RANGE_ROWS)))
    if ranges == 1:
        return keyed.withColumn("_range", F.lit(0)).drop("_tie")
    share = min(1.0, SAMPLED * ranges / n)
    drawn = F.pmod(F.xxhash64("_tie", F.lit("sample")), F.lit(1 << 32)) < F.lit(int(share * (1 << 32)))
    sample = sorted(tuple(r[0]) for r in keyed.where(drawn).select(key).collect())  # SAMPLED keys a range
    bounds = sorted({sample[i * len(sample) // ranges] for i in range(1, ranges)}) if sample else []
    if not bounds:
        return keyed.withColumn("_range", F.lit(0)).drop("_tie")
    # Constant texts that Spark folds to three arrays, searched by halves: the range is the number of bounds that a key reaches.
    orders, hashes, ties = (F.split(F.lit(",".join(str(bound[i]) for bound in bounds)), ",").cast("array<bigint>") for i in range(3))

    def reaches(i: Column) -> Column:
        same_order, same_hash = F.get(orders, i) == F.col(order), F.get(hashes, i) == F.col("_hash")
        after = (F.get(hashes, i) < F.col("_hash")) | (same_hash & (F.get(ties, i) <= F.col("_tie")))
        return (F.get(orders, i) < F.col(order)) | (same_order & after)

    steps = F.array(*(F.lit(1 << i) for i in reversed(range(len(bounds).bit_length()))))
    reached = F.aggregate(steps, F.lit(0), lambda at, step: F.when(reaches(at + step - 1), at + step).otherwise(at))
    return keyed.withColumn("_range", reached).drop("_tie")


def with_next(rows: DataFrame, order: str, text: str, bits: int = BIN_BITS) -> DataFrame:
    """Adds the fingerprint of `text` as `own`, and text and fingerprint of the next row by `order` (then by a hash of the text, then by text) as
    `next_text` and `next_own`; the first row follows on the last.
    """
    rows = _ranged(rows, order, text)
    sequence = Window.partitionBy("_range").orderBy(order, "_hash", text)
    follower = F.lead(F.struct(F.col(text).alias("t"), F.col("own").alias("o"))).over(sequence)
    printed = with_fingerprint(rows, text, "own", bits).withColumn("_next", follower)

    # First texts of the ranges, at most MOST_RANGES of them.
    least = rows.groupBy("_range").agg(F.min(F.struct(F.col(order).alias("o"), F.col("_hash").alias("h"))).alias("_head"))
    following = Window.orderBy("_range")
    lowest = F.min("_head").over(following.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    after = least.select("_range", F.coalesce(F.lead("_head").over(following), lowest).alias("_head"))
    heads = rows.select(F.struct(F.col(order).alias("o"), F.col("_hash").alias("h")).alias("_head"), F.col(text).alias("_head_text"))
    heads = heads.join(F.broadcast(least.select("_head").distinct()), "_head").groupBy("_head").agg(F.min("_head_text").alias("_head_text"))
    heads = after.join(with_fingerprint(heads, "_head_text", "_head_own", bits), "_head").select("_range", "_head_text", "_head_own")

    joined = printed.join(heads, "_range", "left")
    return joined.withColumns({"next_text": F.coalesce("_next.t", "_head_text"), "next_own": F.coalesce("_next.o", "_head_own")}).drop(
        "_range", "_hash", "_next", "_head_text", "_head_own"
    )


def fingerprints(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", bits: int = BIN_BITS) -> DataFrame:
    """doc_id and the fingerprint of every row of `docs`, as an array."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("_t"))
    return with_fingerprint(rows, "_t", "fingerprint", bits).drop("_t")


def compared(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", bits: int = BIN_BITS) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness to each other and to the next document's.

    The edited text has its last half, rounded down, replaced by as many code points from the start of the next document.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), order_id(F.col(doc_id)).alias("_order"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    rows = with_next(rows, "_order", "_text", bits).withColumn("n_chars", F.length("_text"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = rows.withColumn("_edited", F.concat(F.substring("_text", F.lit(1), F.col("n_chars") - half), F.substring("next_text", F.lit(1), half)))
    rows = with_fingerprint(rows, "_edited", "_edited_own", bits)
    return rows.select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"), F.sha2("_edited", 256).alias("edited_sha256"), shown(F.col("own")).alias("fingerprint"),
        shown(F.col("_edited_own")).alias("edited_fingerprint"), likeness(F.col("own"), F.col("_edited_own")).alias("near_edited"),
        likeness(F.col("own"), F.col("next_own")).alias("near_next"),
    )


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compared(read(spark, sf_dir, "documents").select("doc_id", "text"))

"""Near-duplicate documents: MinHash with tensored banding, candidates confirmed on whole shingle sets.

Two collections of BANDS hash groups with ROWS minhashes each are computed per document, 2 * BANDS * ROWS in all. Every
group of the first collection is combined with every group of the second, which gives BANDS ** 2 table keys of 2 * ROWS
minhashes: as many tables as plain banding would compute BANDS ** 2 * 2 * ROWS minhashes for. A pair at the limit of 0.8
shares a key with probability (1 - (1 - 0.8 ** 2) ** 10) ** 2 = 0.99993; likelier pairs are surer.

Documents with one and the same set form a class first, and classes stand for their documents from then on. In a bucket,
classes are compared with its leader only, and components follow from the confirmed links; so a bucket of thousands of near
copies costs one comparison per copy. Buckets whose classes have all come to one component are done. The classes of all
others go through an exact join: two sets that reach the limit share one of their rarest shingles, of which each set of n
has n - ceil(0.8 n) + 1 to compare, and share it early enough for what follows to hold all they must have in common. Pairs within a component are never built, and of the components that share a shingle
the largest is not compared with itself. Nothing is capped.

A candidate pair goes on if its sizes allow the limit, and if at least LIKELY of its 2 * BANDS groups agree (a pair at the
limit agrees in fewer with probability 1e-6); then the whole sets are intersected.

Defined results: a document without words or text has no shingles and is linked with nothing, not even with another such;
one with fewer words than a shingle has its whole sequence as the only shingle; rows with equal or null doc_id are separate
documents; component_id is the smallest doc_id of the component (null if it has none); an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmill.llm.common import free_names, order_id, read, words, written
from tripmill.llm.components import components
from tripmill.llm.shingles import LOWER, gram_codes, joined_codes, mixed
from tripmill.llm.substring_dedup import text_chunks

BANDS, ROWS, COLLECTIONS = 10, 2, 2
LIKELY = 3
PERCENT = 80

SIGNED = "node long, doc_id long, n_shingles int, set_a long, set_b long, bands array<long>"
SIGNED_SCHEMA = pa.schema(
    [("node", pa.int64()), ("doc_id", pa.int64()), ("n_shingles", pa.int32()), ("set_a", pa.int64()), ("set_b", pa.int64()), ("bands", pa.list_(pa.int64()))]
)
SETS = "node long, shingles array<long>"
SETS_SCHEMA = pa.schema([("node", pa.int64()), ("shingles", pa.list_(pa.int64()))])


def shingle_sets(texts: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle codes of each text, one after the other and each in order, and where each text's begin."""
    codes, bounds = joined_codes([text.translate(LOWER) for text in texts])
    lengths = np.diff(bounds)
    grams = gram_codes(codes, n)
    sets = []
    for begin, length in zip(bounds[:-1], lengths, strict=True):
        if length >= n:
            sets.append(np.unique(grams[begin : begin + length - n + 1]))
        elif length:  # the whole sequence
            sets.append(mixed(gram_codes(codes[begin : begin + length], int(length)) + np.uint64(length)))
        else:
            sets.append(codes[:0])
    return np.concatenate(sets) if sets else codes[:0], np.concatenate([[0], np.cumsum([len(s) for s in sets])])


def signer(n: int, seed: int):
    hashes = COLLECTIONS * BANDS * ROWS
    salts = mixed(np.arange(seed, seed + hashes, dtype=np.uint64))
    factors = mixed(salts) | np.uint64(1)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for nodes, ids, texts in text_chunks(batches):
            codes, bounds = shingle_sets(texts, n)
            sizes = np.diff(bounds)
            full = np.flatnonzero(sizes)
            bands = np.zeros((len(texts), COLLECTIONS * BANDS), np.uint64)
            set_a, set_b = np.zeros(len(texts), np.uint64), np.zeros(len(texts), np.uint64)
            if len(full):
                at = bounds[:-1][full]
                set_a[full] = mixed(np.add.reduceat(mixed(codes), at))
                set_b[full] = mixed(np.add.reduceat(mixed(codes ^ factors[0]), at))
                for band in range(COLLECTIONS * BANDS):
                    total = np.full(len(full), band, np.uint64)
                    for j in range(band * ROWS, (band + 1) * ROWS):
                        total = mixed(total ^ np.minimum.reduceat((codes ^ salts[j]) * factors[j], at))
                    bands[full, band] = total
            columns = (
                pa.array(nodes, pa.int64()), pa.array(ids, pa.int64()), pa.array(sizes.astype(np.int32)), pa.array(set_a.view(np.int64)), pa.array(set_b.view(np.int64)),
                pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * (COLLECTIONS * BANDS)), pa.array(bands.view(np.int64).ravel())),
            )
            yield pa.RecordBatch.from_arrays(list(columns), schema=SIGNED_SCHEMA)

    return sign


def set_emitter(n: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for nodes, texts in text_chunks(batches):
            codes, bounds = shingle_sets(texts, n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.int64()), pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(codes.view(np.int64)))], schema=SETS_SCHEMA
            )

    return emit


def _tables(classes: DataFrame) -> DataFrame:
    """(key, node) for every pair of a group of the first collection and one of the second."""
    halves = classes.select("node", F.slice("bands", 1, BANDS).alias("x"), F.slice("bands", BANDS + 1, BANDS).alias("y"))
    left = halves.select("node", "y", F.explode("x").alias("x"))
    return left.select("node", "x", F.explode("y").alias("y")).select(F.xxhash64("x", "y").alias("key"), "node")


def _crowded(members: DataFrame) -> DataFrame:
    """Members of buckets with two or more classes, with the bucket's leader and size."""
    buckets = members.groupBy("key").agg(F.min("node").alias("leader"), F.count("*").alias("size")).where("size > 1")
    return members.join(buckets, "key")


def _confirmed(pairs: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the distinct pairs (a, b) whose whole sets are alike enough."""
    for side in ("a", "b"):
        pairs = pairs.join(classes.select(F.col("node").alias(side), F.col("n_shingles").alias(f"n_{side}"), F.col("bands").alias(f"bands_{side}")), side)
    alike = F.size(F.filter(F.zip_with("bands_a", "bands_b", lambda x, y: x == y), lambda same: same))
    fits = 100 * F.least("n_a", "n_b") >= PERCENT * F.greatest("n_a", "n_b")
    pairs = pairs.where(fits).where(alike >= LIKELY).select("a", "b")
    for side in ("b", "a"):
        pairs = pairs.join(sets.select(F.col("node").alias(side), F.col("shingles").alias(f"set_{side}")), side)
    both = F.size(F.array_intersect("set_a", "set_b"))
    pairs = pairs.select("a", "b", both.alias("both"), (F.size("set_a") + F.size("set_b")).alias("total"))
    return pairs.where(100 * F.col("both") >= PERCENT * (F.col("total") - F.col("both"))).select("a", "b")


def _unsettled(members: DataFrame, roots: DataFrame) -> DataFrame:
    """(node, root) of the classes in buckets of three or more classes that lie in two or more components."""
    members = members.where("size > 2").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_buckets = members.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("key")
    return members.join(open_buckets, "key").select("node", "root").distinct()


def _across(unsettled: DataFrame, sets: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) of classes of different components that share a shingle among their rarest."""
    shingles = sets.join(unsettled, "node").select("node", "root", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    counts = shingles.groupBy("shingle").agg(F.count("*").alias("f"), F.min("root").alias("low"), F.max("root").alias("high"))
    rarest = Window.partitionBy("node").orderBy("f", "shingle")
    prefix = shingles.join(counts, "shingle").withColumn("rank", F.row_number().over(rarest))
    longest = F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1
    prefix = prefix.where((F.col("rank") <= longest) & (F.col("low") != F.col("high"))).select("shingle", "node", "root", "n", "rank")
    prefix = written(prefix, "prefix")
    largest = prefix.groupBy("shingle", "root").agg(F.count("*").alias("c")).groupBy("shingle").agg(F.max_by("root", F.struct("c", "root")).alias("largest"))
    one = prefix.join(largest, "shingle").where("root <> largest")
    one = one.select("shingle", "largest", F.col("node").alias("a"), F.col("root").alias("root_a"), F.col("n").alias("n_a"), F.col("rank").alias("rank_a"))
    other = prefix.select("shingle", F.col("node").alias("b"), F.col("root").alias("root_b"), F.col("n").alias("n_b"), F.col("rank").alias("rank_b"))
    # Seen from the first shingle that two sets share, what is left of either must hold all they share.
    both = f"{100 + PERCENT} * (1 + least(n_a - rank_a, n_b - rank_b)) >= {PERCENT} * (n_a + n_b)"
    fits = f"100 * least(n_a, n_b) >= {PERCENT} * greatest(n_a, n_b) AND {both}"
    return one.join(other, "shingle").where(f"root_a <> root_b AND (root_b = largest OR a < b) AND {fits}").select("a", "b").distinct()


def linked(classes: DataFrame, texts: DataFrame, n: int) -> DataFrame:
    """(node, root) of the classes that have links."""
    members = written(_crowded(_tables(classes)), "members")
    involved = members.select("node").distinct()
    sets = written(texts.join(involved, "node", "left_semi").select("node", "text").mapInArrow(set_emitter(n), SETS), "sets")
    star = members.where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    roots = components(written(_confirmed(star, classes, sets), "links"))
    unsettled = written(_unsettled(members, roots), "unsettled")
    if unsettled.isEmpty():
        return roots
    more = written(_confirmed(_across(unsettled, sets), classes, sets), "links")
    return roots if more.isEmpty() else components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more))


def _node(docs: DataFrame, text: str, doc_id: str) -> tuple[Column, bool]:
    """What tells rows apart: doc_id if that does, else a hash of it and the text."""
    identity = F.col(doc_id).cast("long")
    ids = docs.select(identity.alias("id")).groupBy("id").count()
    unique = ids.where("id IS NULL OR count > 1").isEmpty()
    return identity if unique else F.xxhash64(identity, F.coalesce(F.col(text), F.lit(""))), unique


def _grouped(docs: DataFrame, node: Column, text: str, doc_id: str, n: int, seed: int) -> DataFrame:
    """node, doc_id, n_shingles and root (null without shingles) of every row."""
    texts = docs.select(node.alias("node"), F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    signed = written(texts.mapInArrow(signer(n, seed), SIGNED), "signed")
    sets = signed.where("n_shingles > 0").groupBy("set_a", "set_b", "n_shingles")
    classes = written(sets.agg(F.min("node").alias("node"), F.first("bands").alias("bands")), "classes")
    roots = linked(classes, texts, n)
    # Sets of documents to classes, classes to components.
    named = classes.select("set_a", "set_b", "n_shingles", F.col("node").alias("class")).join(roots.withColumnRenamed("node", "class"), "class", "left")
    named = named.select("set_a", "set_b", "n_shingles", F.coalesce("root", "class").alias("root"))
    keys = ["set_a", "set_b", "n_shingles"]
    return signed.select("node", "doc_id", *keys).join(named, keys, "left").select("node", "doc_id", "n_shingles", "root")


def near_groups(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", n: int = 5, seed: int = 1) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    node, unique = _node(docs, text, doc_id)
    rows = _grouped(docs, node, text, doc_id, n, seed)
    smallest = F.coalesce("root", "doc_id")
    if not unique:
        rows = rows.join(rows.where("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("least")), "root", "left")
        smallest = F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    rows = rows.withColumn("component_id", smallest)
    return rows.select("doc_id", F.col("n_shingles").cast("long").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def one_of_each(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", n: int = 5, seed: int = 1) -> DataFrame:
    """`docs` without near duplicates: of each component the row of the smallest doc_id, of several such the first by a
    hash of the text. Rows without shingles all stay.
    """
    node, unique = _node(docs, text, doc_id)
    rows = _grouped(docs, node, text, doc_id, n, seed).where("root IS NOT NULL")
    if unique:
        going = rows.where("doc_id <> root")
    else:
        first = F.min(F.struct(order_id(F.col("doc_id")).alias("o"), F.col("node").alias("first")))
        going = rows.join(rows.groupBy("root").agg(first.alias("f")), "root").where("node <> f.first")
    (own,) = free_names(docs.columns, "_node")
    left = docs.withColumn(own, node).join(going.select(F.col("node").alias(own)).distinct(), own, "left_anti")
    if not unique:  # rows that are equal in id and text stay once, unless they have no words
        again = left.where(F.size(words(F.col(text))) > 0).dropDuplicates([own])
        left = again.unionByName(left.where(F.size(words(F.col(text))) == 0))
    return left.select(*(F.col(f"`{c}`") for c in docs.columns))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(read(spark, sf_dir, "documents").select("doc_id", "text"), n=2)

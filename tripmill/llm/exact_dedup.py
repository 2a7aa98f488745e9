"""Exact dedup by Grace hashing.

Texts are dealt to buckets by a hash of their content, and each bucket is deduplicated in an open-addressing table that
compares whole texts. A table holds at most TABLE_BYTES of distinct texts; what a full table cannot take goes to files in
the shared folder and is dealt out again by another hash over more buckets, until every bucket fits.

Before anything is shuffled, every task folds the copies among its own rows with the same table, so a text with millions
of copies sends one row per task to its bucket. Rows then find their group by the digest of their text.

Defined results: a null text counts as empty; white space inside and at the ends is one space; a null doc_id is never the
smallest unless all ids of a group are null, and then all its rows count as kept; rows that share the smallest doc_id of
their group are all marked kept, and `without_copies` returns one of them; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm.common import LAST_ID, WORD_GAP, free_names, order_id, read, written

TABLE_BYTES = 48 << 20
FAN_OUT = 8  # times as many buckets at each further level
ROWS_AT_ONCE = 256
OUT_BYTES = 8 << 20

FOLDED = "code long, body binary, first_id long, copies long"
GROUPS = "digest binary, first_id long, copies long, code long, body binary"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WORD_GAP, " ")


class ContentTable:
    """Distinct texts with the smallest id and the number of their copies; linear probing, whole contents compared."""

    def __init__(self, most_bytes: int):
        self.most_bytes, self.held = most_bytes, 0
        self.slots = [-1] * 1024
        self.codes: list[int] = []
        self.texts: list[bytes] = []
        self.firsts: list[int] = []
        self.copies: list[int] = []

    def add(self, code: int, text: bytes, first: int, copies: int) -> bool:
        """False if the text is new and the table is full."""
        mask = len(self.slots) - 1
        at = code & mask
        while (entry := self.slots[at]) >= 0:
            if self.codes[entry] == code and self.texts[entry] == text:
                self.firsts[entry] = min(self.firsts[entry], first)
                self.copies[entry] += copies
                return True
            at = (at + 1) & mask
        if self.texts and self.held + len(text) > self.most_bytes:
            return False
        self.slots[at] = len(self.texts)
        self.codes.append(code)
        self.texts.append(text)
        self.firsts.append(first)
        self.copies.append(copies)
        self.held += len(text) + 200
        if 2 * len(self.texts) > len(self.slots):
            self.grow()
        return True

    def grow(self) -> None:
        mask = 2 * len(self.slots) - 1
        self.slots = [-1] * (mask + 1)
        for entry, code in enumerate(self.codes):
            at = code & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = entry

    def entries(self) -> Iterator[tuple[int, bytes, int, int]]:
        return zip(self.codes, self.texts, self.firsts, self.copies, strict=True)


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield from zip(*(column.to_pylist() for column in batch.slice(at, ROWS_AT_ONCE).columns), strict=True)


def in_batches(rows: Iterator[tuple], schema: pa.Schema, body_at: int) -> Iterator[pa.RecordBatch]:
    """Batches of about OUT_BYTES."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += 64 + len(row[body_at] or b"")
        if size >= OUT_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


LONG, BYTES = pa.int64(), pa.binary()
FOLDED_SCHEMA = pa.schema([("code", LONG), ("body", BYTES), ("first_id", LONG), ("copies", LONG)])
GROUPS_SCHEMA = pa.schema([("digest", BYTES), ("first_id", LONG), ("copies", LONG), ("code", LONG), ("body", BYTES)])


def folder(table_bytes: int):
    """Folds copies among the rows of one task; a full table is handed on and a new one begun."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            table = ContentTable(table_bytes)
            for row in rows_of(batches):
                if not table.add(*row):
                    yield from table.entries()
                    table = ContentTable(table_bytes)
                    table.add(*row)
            yield from table.entries()

        yield from in_batches(rows(), FOLDED_SCHEMA, 1)

    return fold


def bucket_table(table_bytes: int):
    """Groups of one bucket; rows that the full table cannot take come out with their body."""

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            table = ContentTable(table_bytes)
            for code, body, first, copies in rows_of(batches):
                if not table.add(code, body, first, copies):
                    yield None, first, copies, code, body
            for _, body, first, copies in table.entries():
                yield hashlib.sha256(body).digest(), first, copies, None, None

        yield from in_batches(rows(), GROUPS_SCHEMA, 4)

    return group


def content_groups(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per distinct text: digest (SHA-256 of the normalised text), first_id, copies."""
    spark = docs.sparkSession
    body = normalised(F.col(text))
    rows = docs.select(F.xxhash64(body).alias("code"), body.cast("binary").alias("body"), order_id(F.col(doc_id)).alias("first_id"), F.lit(1).cast("long").alias("copies"))
    rows = rows.mapInArrow(folder(table_bytes), FOLDED)
    buckets, level, groups = int(spark.conf.get("spark.sql.shuffle.partitions")), 0, None
    while True:
        dealt = rows.repartition(buckets, F.xxhash64("code", F.lit(level)))
        out = written(dealt.mapInArrow(bucket_table(table_bytes), GROUPS), f"grace-{level}")
        done = out.where("digest IS NOT NULL").select("digest", "first_id", "copies")
        groups = done if groups is None else groups.union(done)
        rows = out.where("digest IS NULL").select("code", "body", "first_id", "copies")
        if rows.isEmpty():
            return groups
        buckets, level = buckets * FAN_OUT, level + 1


def exact_groups(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """Every row of `docs` with keep_id, group_size, kept and text_sha256 after its own columns.

    Own columns of these names are replaced.
    """
    (code,) = free_names(docs.columns, "_digest")
    groups = content_groups(docs, text=text, doc_id=doc_id, table_bytes=table_bytes)
    groups = groups.select(F.col("digest").alias(code), F.nullif("first_id", F.lit(LAST_ID)).alias("keep_id"), F.col("copies").alias("group_size"))
    rows = docs.drop("keep_id", "group_size", "kept", "text_sha256").withColumn(code, F.unhex(F.sha2(normalised(F.col(text)), 256)))
    return rows.join(groups, code).select(
        *(F.col(f"`{name}`") for name in rows.columns if name != code), "keep_id", "group_size",
        F.col(doc_id).cast("long").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex(code)).alias("text_sha256"),
    )


def without_copies(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows that stay, with the columns of `docs`; repeated rows with one id stay once."""
    kept = exact_groups(docs, text=text, doc_id=doc_id).where("kept").dropDuplicates([doc_id, "text_sha256"])
    return kept.select(*(F.col(f"`{name}`") for name in docs.columns))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_groups(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE = r"""
WITH n AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER g AS kept, text_sha256
FROM n WINDOW g AS (PARTITION BY text_sha256)
"""

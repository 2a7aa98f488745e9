"""Best-fit packing into sequences of several permitted lengths.

Documents are measured in words; one longer than the largest length is cut into pieces of that length, the last piece being
the rest. Pieces are dealt to groups by a hash, and each group is packed by itself, largest piece first: a piece goes to the
open bin that it leaves with the least room. If it fits none, a bin is opened, of the length that costs least per word it
can still be filled with; a length costs its words plus OVERHEAD for the sequence. At the end every bin is cut down to the
shortest permitted length that holds its contents. All lengths share the same open bins, so they are optimised together.

A task holds one block of at most BLOCK pieces. Within a group pieces come sorted, so every block is packed as well as a
whole group; what a block wastes is in its last bins, some thousandths of its words.

Defined results: null and blank texts have no words and get one row without a bin; rows that repeat are packed each by
itself; an empty table gives an empty table.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm.common import read, words

LENGTHS = (512, 1024, 2048, 4096, 8192)
OVERHEAD = 16
GROUP_ROWS = 8_000
BLOCK = 50_000

PLACED = "doc_id long, piece int, first_word long, n_words int, bin_id string, bin_length int, bin_start int"
PLACED_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("first_word", pa.int64()), ("n_words", pa.int32()), ("bin_id", pa.string()), ("bin_length", pa.int32()), ("bin_start", pa.int32())]
)


def packed(sizes: list[int], lengths: tuple[int, ...] = LENGTHS, overhead: int = OVERHEAD) -> tuple[list[tuple[int, int]], list[int]]:
    """Bin and start in it of every size, none of them above the largest length; and the final length of every bin."""
    lengths = tuple(sorted(lengths))
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    places: list[tuple[int, int]] = [(0, 0)] * len(sizes)
    room: list[tuple[int, int]] = []  # open bins by the room they have left
    opened, filled = [], []
    rest = sum(sizes)
    for i in order:
        size = sizes[i]
        at = bisect_left(room, (size, -1))
        if at < len(room):
            left, bin_ = room.pop(at)
        else:
            length = min((x for x in lengths if x >= size), key=lambda x: ((x + overhead) / min(x, rest), x))
            bin_, left = len(opened), length
            opened.append(length)
            filled.append(0)
        places[i] = (bin_, filled[bin_])
        filled[bin_] += size
        rest -= size
        if left > size:
            insort(room, (left - size, bin_))
    return places, [next(x for x in lengths if x >= held) for held in filled]


def packer(lengths: tuple[int, ...], overhead: int, block: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, int]] = []  # doc_id, piece, first word, words
        group, number = None, 0

        def done() -> pa.RecordBatch:
            places, final = packed([x[3] for x in held], lengths, overhead)
            names = [f"{group}-{number}-{bin_}" for bin_, _ in places]
            columns = [*zip(*held, strict=True), names, [final[bin_] for bin_, _ in places], [start for _, start in places]]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, PLACED_SCHEMA, strict=True)], schema=PLACED_SCHEMA)

        for batch in batches:
            for own, *piece in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if held and (own != group or len(held) >= block):
                    yield done()
                    held, number = [], number + 1 if own == group else 0
                group = own
                held.append(tuple(piece))
        if held:
            yield done()

    return pack


def pieces(docs: DataFrame, longest: int, *, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, spread, piece, first_word, n_words; documents without words have one piece of 0 words."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(doc_id), F.col(text)).alias("spread"), F.size(words(F.col(text))).alias("n"))
    rows = rows.withColumn("piece", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("n") / longest).cast("int") - 1, F.lit(0)))))
    first = F.col("piece").cast("long") * longest
    return rows.select("doc_id", "spread", "piece", first.alias("first_word"), F.least(F.col("n") - first, F.lit(longest)).cast("int").alias("n_words"))


def packing(
    docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", lengths: tuple[int, ...] = LENGTHS, overhead: int = OVERHEAD, group_rows: int = GROUP_ROWS, block: int = BLOCK
) -> DataFrame:
    """Where every piece of every document goes: its bin, the bin's length and the piece's start in it."""
    parts = pieces(docs, max(lengths), text=text, doc_id=doc_id)
    groups = max(1, docs.count() // group_rows)
    hold = parts.where("n_words > 0").withColumn("group", F.pmod(F.xxhash64("spread", "piece"), F.lit(groups)))
    tasks = min(groups, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    hold = hold.repartition(tasks, "group").sortWithinPartitions("group", F.desc("n_words"), "spread", "piece")
    placed = hold.select("group", "doc_id", "piece", "first_word", "n_words").mapInArrow(packer(tuple(lengths), overhead, block), PLACED)
    empty = parts.where("n_words = 0").select("doc_id", "piece", "first_word", "n_words", F.lit(None).cast("string").alias("bin_id"), F.lit(None).cast("int").alias("bin_length"), F.lit(None).cast("int").alias("bin_start"))
    return placed.union(empty)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing(read(spark, sf_dir, "documents").select("doc_id", "text"))

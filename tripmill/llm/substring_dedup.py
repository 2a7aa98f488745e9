"""Substring dedup: words covered by a window of WINDOW words that also starts anywhere else are removed.

The work follows a sparse de Bruijn graph. Nodes are K-word k-mers; of each window, the k-mer with the least code (a
minimizer) becomes a node, so equal windows share a node at the same offset. Two nodes at most K words apart in a text are
joined by an edge, and as k-mers then touch or overlap, an edge fixes all its words.

1. Nodes are counted; only nodes with two or more occurrences matter from here on.
2. Edges between neighbouring repeated nodes are counted. Where an edge, the node behind it and the next edge occur equally
   often, the path does not branch there: such edges compact into one path, whose every occurrence has the same words.
3. The coordinates of the paths lead back to the texts. Of each path the code of all its words (96 bits) is taken; of
   windows that hold a repeated node but lie in no path (near branches and ends), the code of each window. Codes that
   occur twice or more are the long repeated spans.
4. The words under these spans go, and the rest is digested.

Every count is a plain grouping, so a passage in a third of all documents folds in the tasks that read it. Counts are
written before they are joined back, so both sides of a join are plain shuffles, whose hot keys adaptive execution splits. The only groups that a task holds are of one document.

Defined results: a null text has no words; a text of fewer than WINDOW words keeps all; rows that share a doc_id, or have
none, are told apart by their text, and if that is equal too, each repeats the other; an empty table gives an empty table.
Nodes and edges have 64-bit codes: should two of them clash, words may wrongly stay, never wrongly go.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmill.llm.common import read, written
from tripmill.llm.shingles import chunks, gram_codes, joined_codes, mixed, powers, sliding

WINDOW = 35
K = WINDOW // 2 + 1  # so that neighbouring nodes of a window's length leave no word between them
SECOND = np.uint64(0xD6E8FEB86659FD93)
HIGHEST = np.uint64(2**64 - 1)
ROWS_AT_ONCE = 1024

NODES = "key long, at int, node long"
PIECES = "key long, span long, code_a long, code_b int"  # span: first word << 32 | words
NODES_SCHEMA = pa.schema([("key", pa.int64()), ("at", pa.int32()), ("node", pa.int64())])
PIECES_SCHEMA = pa.schema([("key", pa.int64()), ("span", pa.int64()), ("code_a", pa.int64()), ("code_b", pa.int32())])
PACKED = "key long, doc_id long, size int, packed binary"
PACKED_SCHEMA = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("size", pa.int32()), ("packed", pa.binary())])
KEPT = "key long, doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"
KEPT_SCHEMA = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept_text", pa.string())])


def text_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[list]]:
    """Columns of some rows at a time, about half a megabyte of text; column `text` is binary."""
    for batch in batches:
        names = batch.schema.names
        for begin in range(0, batch.num_rows, ROWS_AT_ONCE):
            rows = batch.slice(begin, ROWS_AT_ONCE)
            columns = [column.to_pylist() for column in rows.columns]
            sizes = [len(text) for text in columns[names.index("text")]]
            for a, b in chunks(sizes):
                yield [column[a:b] for column in columns]


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed one by one, as they are shuffled whole."""
    for keys, ids, texts in text_chunks(batches):
        packed = [pa.compress(text, codec="zstd", asbytes=True) for text in texts]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((keys, ids, [len(t) for t in texts], packed), PACKED_SCHEMA, strict=True)], schema=PACKED_SCHEMA)


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[list[list]]:
    """Columns of some rows at a time with the texts as they were; expects key, doc_id, size, packed and others."""
    for batch in batches:
        for begin in range(0, batch.num_rows, ROWS_AT_ONCE):
            keys, ids, sizes, packed, *others = (column.to_pylist() for column in batch.slice(begin, ROWS_AT_ONCE).columns)
            for a, b in chunks(sizes):
                texts = [pa.decompress(x, n, codec="zstd", asbytes=True) if n else b"" for x, n in zip(packed[a:b], sizes[a:b], strict=True)]
                yield [keys[a:b], ids[a:b], texts, *(column[a:b] for column in others)]


class Grid:
    """Codes of the texts' k-mers, and which of them their windows select."""

    def __init__(self, texts: list[bytes], window: int, k: int):
        self.codes, self.bounds = joined_codes(texts)
        n = len(self.codes)
        self.kmers = gram_codes(self.codes, k)
        self.least = sliding(self.kmers, window - k + 1)  # by the window's first word
        place = np.arange(n) - np.repeat(self.bounds[:-1], np.diff(self.bounds))
        left = np.repeat(self.bounds[1:], np.diff(self.bounds)) - np.arange(n)
        self.place, self.whole = place, (left >= window)[: len(self.least)]
        self.spread = window - k  # a window's nodes begin at its first word to this many later

    def selected(self) -> np.ndarray:
        """Where the selected k-mers begin."""
        if not len(self.least):
            return np.zeros(0, np.int64)
        least = np.where(self.whole, self.least, 0)
        padded = np.concatenate([np.zeros(self.spread, np.uint64), least, np.zeros(self.spread, np.uint64)])
        reach = sliding(padded, self.spread + 1, np.maximum)[: len(self.kmers)]
        return np.flatnonzero((reach == self.kmers) & (self.kmers > 0))


def node_emitter(window: int, k: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in text_chunks(batches):
            grid = Grid(texts, window, k)
            at = grid.selected()
            owner = np.searchsorted(grid.bounds, at, "right") - 1
            columns = np.array(keys, np.int64)[owner], grid.place[at].astype(np.int32), grid.kmers[at].view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=NODES_SCHEMA)

    return emit


def span_codes(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, base: np.uint64) -> np.ndarray:
    """Codes of spans of any length, from running sums; equal to gram codes of that length only among themselves."""
    weights = powers(base, len(codes))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * weights, dtype=np.uint64)])
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    return mixed((sums[starts + lengths] - sums[starts]) * powers(inverse, len(codes))[starts])


def piece_emitter(window: int, k: int):
    """Spans to compare: whole paths, and windows with a repeated node that no path covers."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, _, texts, nodes, starts, ends in unpacked(batches):
            chosen = [i for i, own in enumerate(nodes) if own]
            if not chosen:
                continue
            grid = Grid([texts[i] for i in chosen], window, k)
            n = len(grid.codes)
            repeated = np.full(len(grid.kmers), HIGHEST)
            covered = np.zeros(n + 1, np.int64)
            path_at, path_length = [], []
            for row, i in enumerate(chosen):
                begin = grid.bounds[row]
                at = begin + np.array(nodes[i], np.int64)
                repeated[at] = grid.kmers[at]
                for a, b in zip(starts[i] or (), ends[i] or (), strict=True):
                    # A window whose node is an end of the path may stand elsewhere without the path; it begins or ends
                    # with the path and is compared by itself. All others, from a + 1 to b - window - 1, go with the path.
                    if b - a >= window + 2:
                        covered[begin + a + 1] += 1
                        covered[begin + b - window] -= 1
                        path_at.append(begin + a)
                        path_length.append(b - a)
            open_windows = grid.whole & (sliding(repeated, grid.spread + 1) == grid.least) & (np.cumsum(covered)[: len(grid.least)] == 0)
            window_at = np.flatnonzero(open_windows)
            at = np.concatenate([window_at, np.array(path_at, np.int64)])
            length = np.concatenate([np.full(len(window_at), window), np.array(path_length, np.int64)]).astype(np.int64)
            if not len(at):
                continue
            owner = np.searchsorted(grid.bounds, at, "right") - 1
            code_a = span_codes(grid.codes, at, length, mixed(np.array([1], np.uint64))[0] | np.uint64(1))
            code_b = span_codes(mixed(grid.codes ^ SECOND), at, length, SECOND)
            columns = (
                np.array([keys[i] for i in chosen], np.int64)[owner], grid.place[at] << 32 | length,
                mixed(code_a ^ length.astype(np.uint64)).view(np.int64), (code_b >> np.uint64(32)).astype(np.uint32).view(np.int32),
            )
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=PIECES_SCHEMA)

    return emit


def remover(with_text: bool):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, ids, texts, spans in unpacked(batches):
            rows = []
            for key, doc_id, text, own in zip(keys, ids, texts, spans, strict=True):
                words = text.split()
                kept = words
                if own:
                    cover = np.zeros(len(words) + 1, np.int64)
                    span = np.array(own, np.int64)
                    at, length = span >> 32, span & 0xFFFFFFFF
                    np.add.at(cover, at, 1)
                    np.add.at(cover, at + length, -1)
                    kept = list(compress(words, (np.cumsum(cover[:-1]) == 0).tolist()))
                joined = b" ".join(kept)
                rows.append((key, doc_id, len(words), len(words) - len(kept), hashlib.sha256(joined).hexdigest(), joined.decode() if with_text else None))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), KEPT_SCHEMA, strict=True)], schema=KEPT_SCHEMA)

    return remove


def repeated_nodes(texts: DataFrame, window: int, k: int) -> DataFrame:
    """key, at, node, n of the selected k-mers that occur twice or more."""
    nodes = texts.select("key", "text").mapInArrow(node_emitter(window, k), NODES)
    # Written first, so that both sides of the join are plain shuffles, whose hot keys Spark splits.
    counts = written(nodes.groupBy("node").agg(F.count("*").alias("n")).where("n > 1"), "node-counts")
    return nodes.join(counts, "node")


def paths(nodes: DataFrame, k: int) -> DataFrame:
    """For each document its repeated nodes, and starts and ends of the paths that edges compact into."""
    # Rows that are equal in all columns have the same key; their nodes count once from here.
    nodes = nodes.repartition("key").groupBy("key", "at").agg(F.first("node").alias("node"), F.first("n").alias("n"))
    along = Window.partitionBy("key").orderBy("at")
    edges = nodes.select("key", "at", "node", "n", *(F.lead(c).over(along).alias(f"next_{c}") for c in ("at", "node", "n")))
    gap = F.col("next_at") - F.col("at")
    edges = edges.select("key", "at", "n", "next_at", "next_n", F.when(gap <= k, F.xxhash64("node", gap, "next_node")).alias("edge"))
    edges = written(edges.where("edge IS NOT NULL"), "edges")
    counts = written(edges.groupBy("edge").agg(F.count("*").alias("m")).where("m > 1"), "edge-counts")
    linked = edges.join(counts, "edge").select("key", "at", "n", "next_at", "next_n", "m")

    before = {c: F.lag(c).over(along) for c in ("next_at", "m")}
    goes_on = (before["next_at"] == F.col("at")) & (before["m"] == F.col("n")) & (F.col("n") == F.col("m"))
    runs = linked.repartition("key").withColumn("new", F.when(goes_on, 0).otherwise(1))
    runs = runs.withColumn("run", F.sum("new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    spans = runs.groupBy("key", "run").agg(F.min("at").alias("a"), (F.max("next_at") + k).alias("b"))
    spans = spans.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("s"))
    marks = nodes.groupBy("key").agg(F.collect_list("at").alias("nodes")).join(spans, "key", "left")
    return marks.select("key", "nodes", F.col("s.a").alias("starts"), F.col("s.b").alias("ends"))


def without_repeats(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW, with_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept_text (null unless `with_text`) of every row of `docs`."""
    k = window // 2 + 1
    identity, body = F.col(doc_id).cast("long"), F.coalesce(F.col(text), F.lit(""))
    ids = docs.select(identity.alias("id")).groupBy("id").count()
    if not ids.where("id IS NULL OR count > 1").isEmpty():
        key = F.xxhash64(identity, body)
    else:
        key = identity
    texts = docs.select(key.alias("key"), identity.alias("doc_id"), body.cast("binary").alias("text"))
    marks = paths(written(repeated_nodes(texts, window, k), "nodes"), k)
    # Both joins with the texts deal them out alike, by one exchange.
    packed = texts.mapInArrow(pack, PACKED)
    pieces = packed.join(marks, "key", "left").select("key", "doc_id", "size", "packed", "nodes", "starts", "ends")
    pieces = written(pieces.mapInArrow(piece_emitter(window, k), PIECES), "pieces")
    same = written(pieces.groupBy("code_a", "code_b").agg(F.count("*").alias("n")).where("n > 1").drop("n"), "repeated-pieces")
    spans = pieces.join(same, ["code_a", "code_b"]).groupBy("key").agg(F.collect_list("span").alias("spans"))
    whole = packed.join(spans, "key", "left").select("key", "doc_id", "size", "packed", "spans")
    return whole.mapInArrow(remover(with_text), KEPT).drop("key")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return without_repeats(docs, with_text=False).drop("kept_text")


ORACLE = rf"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), starts AS (
  SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + {WINDOW - 1}), ' ')) AS code
  FROM d, unnest(range(1, greatest(len(w) - {WINDOW - 2}, 1))) AS u(i)
), hits AS (
  SELECT doc_id, list(DISTINCT i + o) AS gone
  FROM starts, range({WINDOW}) AS r(o)
  WHERE code IN (SELECT code FROM starts GROUP BY code HAVING count(*) > 1) GROUP BY doc_id
), k AS (
  SELECT doc_id, w, coalesce(len(gone), 0) AS n_removed,
         CASE WHEN gone IS NULL THEN w ELSE list_transform(list_filter(range(1, len(w) + 1), lambda x: NOT list_contains(gone, x)), lambda x: w[x]) END AS kept
  FROM d LEFT JOIN hits USING (doc_id)
)
SELECT doc_id, len(w)::BIGINT AS n_words, n_removed::BIGINT AS n_removed, sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256 FROM k
"""

"""Sharding, packing and the pipeline."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from tests.llm import brute
from tripmill.llm import packing, sharding
from tripmill.llm.common import read

SF_DIR = "/root/testdata/sf0.001"
TABLES = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no provided tables")


def check_shards(rows, out):
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    slots = defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())
    counts = [len(slots[s]) for s in range(8)]
    assert max(counts) - min(counts) <= 1 and set(slots) <= set(range(8))


def cut(out):
    """Rows outside the shard that holds most of their text."""
    held = defaultdict(Counter)
    for r in out:
        held[r["text_crc32"], r["size"]][r["shard"]] += 1
    return sum(sum(c.values()) - max(c.values()) for c in held.values())


def test_shards_keep_copies_together(docs):
    rows = [(i, f"text {i % 400}") for i in range(1000)] + [(2000 + i, f"own {i}") for i in range(1500)]
    out = sharding.sharded(docs(rows)).collect()
    check_shards(rows, out)
    spread = cut([{**r.asDict(), "shard": zlib.crc32(str(r["doc_id"]).encode()) % 8} for r in out])
    assert cut(out) < 0.2 * spread


def test_shards_of_one_large_group(docs):
    rows = [(i, "copy") for i in range(900)] + [(1000 + i, f"own {i}") for i in range(301)]
    out = sharding.sharded(docs(rows)).collect()
    check_shards(rows, out)


def test_shards_keep_a_group_that_fits_one_shard(docs):
    rows = [(i, "copy") for i in range(400)] + [(1000 + i, f"text {i % 600}") for i in range(1200)] + [(3000 + i, f"own {i}") for i in range(2400)]
    out = sharding.sharded(docs(rows)).collect()
    check_shards(rows, out)
    assert cut(out) == 0


def test_shards_keep_pairs_beside_a_group_that_fits_none(docs):
    rows = [(i, "copy") for i in range(1000)] + [(2000 + i, f"text {i % 400}") for i in range(800)] + [(4000 + i, f"own {i}") for i in range(1200)]
    out = sharding.sharded(docs(rows)).collect()
    check_shards(rows, out)
    assert cut([r for r in out if r["text_crc32"] != zlib.crc32(b"copy")]) == 0


def test_wishes_are_granted_within_rooms_and_small_groups_first():
    room = dict.fromkeys(range(sharding.SHARDS), 0)
    assert sharding._granted({(0, 1, 1, 0): 5, (1, 2, 1, 0): 5, (2, 0, 1, 0): 5, (3, 1, 1, 0): 5}, room) == {(0, 1, 1, 0), (1, 2, 1, 0), (2, 0, 1, 0)}
    assert sharding._granted({(0, 1, 9, 0): 6, (2, 1, 1, 0): 5}, {**room, 1: 8}) == {(2, 1, 1, 0)}


@pytest.mark.parametrize("n", [0, 1, 7, 9])
def test_shards_of_few_rows(docs, n):
    rows = [(i, "same") for i in range(n)]
    check_shards(rows, sharding.sharded(docs(rows)).collect())


def test_shards_odd_rows(docs, odd_rows):
    check_shards(odd_rows, sharding.sharded(docs(odd_rows).withColumn("grp", F.lit(1)).withColumn("shard", F.lit(1))).collect())


# packing


def check_bins(rows, out, lengths):
    spans, bins = defaultdict(list), defaultdict(list)
    for r in out:
        spans[r["doc_id"]].append((r["first_word"], r["n_words"]))
        if r["bin_id"] is None:
            assert r["n_words"] == 0
        else:
            bins[r["bin_id"], r["bin_length"]].append((r["bin_start"], r["n_words"]))
    want = Counter()
    for i, t in rows:
        n = len(brute.words(t))
        want.update((i, a, min(max(lengths), n - a)) for a in range(0, max(n, 1), max(lengths)))
    assert Counter((r["doc_id"], r["first_word"], r["n_words"]) for r in out) == want
    assert len({b for b, _ in bins}) == len(bins)
    for (_, length), own in bins.items():
        end = 0
        for start, n in sorted(own):
            assert start == end
            end = start + n
        assert length == min(x for x in lengths if x >= end)
    return sum(length for _, length in bins)


def test_packing_random(docs, random_rows):
    rows = random_rows(31, 300)
    lengths = (16, 32, 64, 128)
    space = check_bins(rows, packing.packing(docs(rows), lengths=lengths, group_rows=100, block=70).collect(), lengths)
    words = sum(len(brute.words(t)) for _, t in rows)
    assert space < 1.1 * words


def test_packing_odd_rows(docs, odd_rows):
    out = packing.packing(docs(odd_rows).withColumn("piece", F.lit("mine")), lengths=(8, 4096)).collect()
    check_bins(odd_rows, out, (8, 4096))
    assert packing.packing(docs([])).isEmpty()


def test_best_fit_takes_the_tightest_bin():
    places, final = packing.packed([10, 6, 4, 3], (10, 16), overhead=4)
    assert final == [16, 10] and places == [(0, 0), (0, 10), (1, 0), (1, 4)]
    assert packing.packed([7], (8, 64))[1] == [8]
    assert packing.packed([]) == ([], [])


# pipeline


@TABLES
def test_pipeline_stages(spark):
    docs = read(spark, SF_DIR, "documents")
    docs = docs.withColumn("extra", F.lit(1)).unionByName(docs.where("doc_id < 3").withColumn("extra", F.lit(2)).withColumn("doc_id", F.lit(None).cast("long")).withColumn("text", F.lit(None).cast("string")))
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.written(stage(spark, docs, SF_DIR), f"test-{name}")
        assert out.columns == corpus_pipeline.COLUMNS
        assert out.count() <= before if name != "mixing" else out.count() >= before
        if name == "near_dedup":
            rows = [(r["doc_id"], r["text"]) for r in out.collect()]
            assert all(kept for _, n, _, kept in brute.near(rows, 5) if n)
        docs, before = out, out.count()
    placed = corpus_pipeline.into_sequences(spark, docs, SF_DIR).collect()
    check_bins([(r["doc_id"], r["text"]) for r in docs.collect()], placed, packing.LENGTHS)


@TABLES
@pytest.mark.parametrize("name", [n for n in entry_points.queries() if n.startswith("op") and n in entry_points.oracle_sql()])
def test_query_and_twin(spark, name):
    from verification.compare import _bag, connect

    out = entry_points.queries()[name](spark, SF_DIR)
    twin = connect(SF_DIR).execute(entry_points.oracle_sql()[name])
    assert _bag(out.columns, out.collect()) == _bag([c[0] for c in twin.description], twin.fetchall())

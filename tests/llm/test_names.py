"""Columns of a user that have the names that operators use inside."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tripmill.llm import exact_dedup, line_dedup, mixing, near_dedup, toxicity
from tripmill.llm.common import free_names

TEXTS = [(1, "one two three four five six\nmore of it here now"), (2, "one two three four five six\nmore of it here now"), (3, "something else that stands alone"), (4, None)]


@pytest.fixture
def named(docs):
    """Documents with columns of the given names, which hold their name and the doc_id."""
    return lambda *names: docs(TEXTS).withColumns({name: F.concat(F.lit(f"{name} of "), F.col("doc_id")) for name in names})


def held(df, *names):
    """Whether each of the columns has its own values still."""
    rows = df.select("doc_id", *names).collect()
    return rows and all(r[name] == f"{name} of {r['doc_id']}" for r in rows for name in names)


def test_free_names():
    assert free_names(["a", "_B", "__b"], "x", "_b", "A") == ["x", "___b", "_A"]


def test_near_dedup_names(named):
    own = ("_node", "__node", "node", "root", "n_shingles", "component_id", "kept")
    out = near_dedup.one_of_each(named(*own))
    assert held(out, *own) and out.count() == 3
    again = named(*own).union(named(*own))  # rows that share their doc_id
    assert held(near_dedup.one_of_each(again), *own)


def test_line_dedup_names(named):
    own = ("_row", "_gone", "_lost", "row", "gone", "order", "line")
    out = line_dedup.without_repeated_lines(named(*own, "n_lines", "n_removed"))
    assert held(out, *own) and out.columns.count("n_lines") == out.columns.count("n_removed") == 1
    assert {r["doc_id"]: r["n_removed"] for r in out.collect()} == {1: 0, 2: 2, 3: 0, 4: 0}


def test_mixing_names(named):
    own = ("_key", "_chance", "key", "word", "number")
    out = mixing.mixed(named(*own, "rate", "copies"), named().withColumn("domain", F.lit("en")), mixing.TARGETS)
    assert held(out, *own) and out.columns.count("rate") == 1 and out.count() == 4


def test_exact_dedup_names(named):
    own = ("_digest", "digest", "code", "first_id", "body")
    assert held(exact_dedup.exact_groups(named(*own)), *own)


def test_toxicity_names(named, spark):
    own = ("_text", "_doc_id", "_score", "_spans")
    labels = spark.createDataFrame([(1, 0, 0), (3, 1, 1)], "doc_id long, quality int, toxic int")
    out = toxicity.toxicity(named(*own, "score"), labels, carried=["doc_id", "text", *own, "score"])
    assert held(out, *own) and out.columns == ["doc_id", "text", *own, "held_out", "score", "predicted", "spans"]

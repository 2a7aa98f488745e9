"""Exact, substring, near and line dedup against plain versions."""

from __future__ import annotations

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tripmill.llm import exact_dedup, line_dedup, near_dedup, substring_dedup


def bag(df):
    return Counter(map(tuple, df.collect()))


# exact dedup


def exact_of(df, **more):
    return bag(exact_dedup.exact_groups(df, **more).select("doc_id", "keep_id", "group_size", "kept", "text_sha256"))


def test_exact_random(docs, random_rows):
    rows = random_rows(1, 60)
    assert exact_of(docs(rows)) == Counter(brute.exact(rows))


def test_exact_odd_rows(docs, odd_rows):
    assert exact_of(docs(odd_rows)) == Counter(brute.exact(odd_rows))


def test_exact_tables_that_overflow_go_to_further_levels(docs, random_rows):
    rows = random_rows(2, 120)
    assert exact_of(docs(rows), table_bytes=600) == Counter(brute.exact(rows))


def test_exact_table_compares_whole_texts_of_one_code():
    table = exact_dedup.ContentTable(1 << 20)
    for k in range(3000):
        assert table.add(k % 7, str(k % 1500).encode(), 5000 - k, 1)
    entries = {text: (first, copies) for _, text, first, copies in table.entries()}
    # 1500 is no multiple of 7, so one text may stand under two codes.
    assert sum(c for _, c in entries.values()) <= 3000 and len(entries) == 1500


def test_exact_empty_and_clashing(docs, spark):
    assert exact_dedup.exact_groups(docs([])).isEmpty()
    own = docs([(1, "a"), (2, "a")]).withColumn("kept", F.lit("mine")).withColumn("code", F.lit(1)).withColumn("digest", F.lit(2))
    assert {(r["doc_id"], r["kept"], r["code"]) for r in exact_dedup.exact_groups(own).collect()} == {(1, True, 1), (2, False, 1)}
    assert [r["doc_id"] for r in exact_dedup.without_copies(docs([(1, "a"), (1, "a"), (2, "a b")])).orderBy("doc_id").collect()] == [1, 2]


# substring dedup


@pytest.mark.parametrize(("seed", "window"), [(3, 35), (4, 35), (5, 8), (6, 3)])
def test_substrings_random(docs, random_rows, seed, window):
    rows = random_rows(seed, 50)
    got = bag(substring_dedup.without_repeats(docs(rows), window=window).select("doc_id", "n_words", "n_removed", "kept_text"))
    assert got == Counter(brute.without_repeats(rows, window))


def test_substrings_of_periodic_texts(docs):
    cycle = [f"c{i}" for i in range(30)]
    rows = [(1, " ".join(cycle * 5)), (2, "same " * 90), (3, " ".join(cycle[3:] + cycle * 2 + ["new"] + cycle)), (4, " ".join(f"u{i}" for i in range(99)))]
    got = bag(substring_dedup.without_repeats(docs(rows)).select("doc_id", "n_words", "n_removed", "kept_text"))
    assert got == Counter(brute.without_repeats(rows, 35))


def test_substrings_odd_rows(docs, odd_rows):
    got = substring_dedup.without_repeats(docs(odd_rows))
    want = brute.without_repeats(odd_rows, 35)
    assert bag(got.select("doc_id", "n_words", "n_removed", "kept_sha256")) == Counter((i, n, m, hashlib.sha256(t.encode()).hexdigest()) for i, n, m, t in want)


def test_substrings_empty_and_clashing(docs):
    assert substring_dedup.without_repeats(docs([])).isEmpty()
    own = docs([(1, "a b")]).withColumn("key", F.lit(9)).withColumn("packed", F.lit(9)).withColumn("spans", F.lit(9))
    assert substring_dedup.without_repeats(own).first()["kept_text"] == "a b"


# near duplicates


@pytest.mark.parametrize(("seed", "n"), [(7, 2), (8, 2), (9, 5), (10, 1)])
def test_near_random(docs, random_rows, seed, n):
    rows = random_rows(seed, 70)
    assert bag(near_dedup.near_groups(docs(rows), n=n)) == Counter(brute.near(rows, n))


def test_near_odd_rows(docs, odd_rows):
    for n in (2, 5):
        assert bag(near_dedup.near_groups(docs(odd_rows), n=n)) == Counter(brute.near(odd_rows, n))


def test_near_chains_and_crowded_buckets(docs):
    # Every text shares most of its shingles with all others, but only neighbours reach the limit.
    base = [f"b{i}" for i in range(30)]
    rows = [(i, " ".join(base + [f"t{j}" for j in range(2 * i, 2 * i + 6)])) for i in range(40)]
    rows += [(100 + i, " ".join(base[:20] + [f"q{i}-{j}" for j in range(9)])) for i in range(40)]
    assert bag(near_dedup.near_groups(docs(rows), n=2)) == Counter(brute.near(rows, 2))


def test_near_one_of_each(docs, odd_rows):
    kept = near_dedup.one_of_each(docs([(1, "a b c d e f g h i j"), (2, "a b c d e f g h i j"), (3, ""), (4, None)]))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4]
    kept = near_dedup.one_of_each(docs(odd_rows))
    assert kept.columns == docs(odd_rows).columns
    texts = Counter(r["text"] for r in kept.collect())
    assert texts["one two three four five six"] + texts["one  two\tthree four five\nsix"] + texts["one two three four five six seven"] == 2
    assert texts[None] == 2 and texts["word"] == 1


def test_near_empty_and_clashing(docs):
    assert near_dedup.near_groups(docs([])).isEmpty()
    assert near_dedup.one_of_each(docs([])).isEmpty()
    own = docs([(1, "a b c"), (2, "a b c")]).withColumn("node", F.lit(5)).withColumn("root", F.lit(5)).withColumn("kept", F.lit(5))
    assert [(r["doc_id"], r["node"]) for r in near_dedup.one_of_each(own).collect()] == [(1, 5)]


# lines


def lines_of(df):
    out = line_dedup.without_repeated_lines(df)
    return {r["doc_id"]: (r["n_lines"], r["n_removed"], r["text"]) for r in out.collect()}


def expected(rows):
    want = brute.repeated_lines(rows)
    text = {i: t for i, t in rows}
    return {i: (n, len(g), text[i] if not g else "\n".join(x for k, x in enumerate((text[i] or "").split("\n")) if k not in g)) for i, (n, g) in want.items()}


@pytest.mark.parametrize("seed", [11, 12, 13])
def test_lines_random(docs, random_rows, seed):
    rows = random_rows(seed, 50)
    assert lines_of(docs(rows)) == expected(rows)


def test_lines_edits(docs):
    base = [f"l{i}" for i in range(9)]
    variants = [base, [*base[:4], "new", *base[4:]], base[:3] + base[4:], [*base[:-1], "z"], ["y", *base[1:]], base[2:], base[::-1], base[:5], base[:4], [*base[:4], "q"], ["the", "the", *base], ["the", *base]]
    rows = [(i, "\n".join([" ".join(v), f"only {i} here and nowhere else at all"])) for i, v in enumerate(variants)]
    assert lines_of(docs(rows)) == expected(rows)


def test_lines_of_equal_and_alternating_words(docs):
    runs = [["a"] * n for n in (4, 5, 6, 6, 7, 9)] + [["a"] * 3 + ["b"] + ["a"] * 4, ["a"] * 5 + ["b"] + ["a"] * 2, ["a"] * 8 + ["b"], ["a", "b"] * 4, ["b", "a"] * 4, ["a", "b"] * 3 + ["a"]]
    for rows in (runs, runs[::-1]):
        rows = [(i, " ".join(w)) for i, w in enumerate(rows)]
        assert lines_of(docs(rows)) == expected(rows)


def test_lines_of_very_many_equal_words(docs):
    n = 200_000
    rows = [(1, "la " * n), (2, "la " * (n + 1)), (3, "la " * (n + 3)), (4, "la li " * n), (5, "la li " * n + "la"), (6, "li la " * (n - 5))]
    assert {i: removed for i, (_, removed, _) in lines_of(docs(rows)).items()} == {1: 0, 2: 1, 3: 0, 4: 0, 5: 1, 6: 0}


def test_lines_odd_rows(docs, odd_rows):
    distinct = list({i: (i, t) for i, t in odd_rows}.values())
    assert lines_of(docs(distinct)) == expected(distinct)
    out = line_dedup.without_repeated_lines(docs(odd_rows))
    assert out.count() == len(odd_rows)


def test_lines_empty_and_clashing(docs):
    assert line_dedup.without_repeated_lines(docs([])).isEmpty()
    own = docs([(1, "a\na"), (2, "a")]).withColumn("row", F.lit(1)).withColumn("order", F.lit(1)).withColumn("n_lines", F.lit(77)).withColumn("gone", F.lit(1))
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["row"]) for r in line_dedup.without_repeated_lines(own).collect()}
    assert got == {1: ("a", 2, 1), 2: ("", 1, 1)}


def test_lines_stay_in_the_jvm(docs):
    plan = line_dedup.repeated_lines(line_dedup._rows(docs([(1, "a")]), "text", "doc_id")[0])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan

"""Prefix trie, filter audit and language identification against plain versions."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tripmill.llm import filter_audit, language_id, prefix_trie

# prefix trie

TURNS = "conv_id long, turn long, role string, text string"


def turn_key(turn, role, text):
    return (turn is not None, turn or 0, hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest())


def trie(rows):
    """[(conv_id, turn, role, text)] -> the nodes, by walking over all prefixes."""
    own = defaultdict(list)
    for c, n, role, text in rows:
        if c is not None:
            own[c].append((turn_key(n, role or "", text or ""), role or "", text or ""))
    turns = {c: [(r, t) for _, r, t in sorted(x)] for c, x in own.items()}
    whole = {}
    for c in turns:
        h, base = zlib.crc32(str(c).encode()) % 6, c - int(math.fmod(c, 100))
        whole[c] = turns.get(base, [])[:h] + turns[c][h:]
    members = defaultdict(list)
    for c, x in whole.items():
        for d in range(len(x) + 1):
            members[tuple(x[:d])].append(c)
    out = []
    for node, convs in members.items():
        below = [v for v in members if v[: len(node)] == node]
        ends = ",".join(str(c) for c in sorted(convs) if len(whole[c]) == len(node))
        out.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), sum(len(v) == len(node) + 1 for v in below),
            sum(not any(len(w) == len(v) + 1 and w[: len(v)] == v for w in below) for v in below), sum((len(members[v]) - 1) * len(v[-1][1]) for v in below if v),
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return Counter(out)


def trie_of(df):
    return Counter(tuple(r) for r in prefix_trie.prefix_trie(df).collect())


def random_turns(seed, convs, most):
    rng = random.Random(seed)
    rows = []
    for c in convs:
        rows += [(c, n, rng.choice(["user", "assistant"]), rng.choice(["ja", "nein", "é𝄞", "so it goes", ""])) for n in range(rng.randrange(1, most))]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "most"), [(1, 9), (2, 3), (3, 30)])
def test_trie_random(spark, seed, most):
    rows = random_turns(seed, [*range(60), *range(130, 160), 500, -7, -200, -201, 12345678901], most)
    assert trie_of(spark.createDataFrame(rows, TURNS).repartition(5)) == trie(rows)


def test_trie_odd_rows(spark):
    rows = [
        (1, None, None, None), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "user", "b"), (1, 7, "x", None), (3, 2, None, "a"), (None, 0, "user", "lost"), (200, 0, "u", "z" * 100_000),
        *((c, 0, "u", "same") for c in (201, 202, 203, 204, 205, 206)), *((900 + c, n, "", "") for c in range(12) for n in range(c)),
    ]
    got = trie_of(spark.createDataFrame(rows, TURNS))
    assert got == trie(rows)
    assert any(depth == 0 and ends != prefix_trie.NONE_SHA256 for _, depth, *_, ends in got)  # some conversation lost all its turns


def test_trie_of_long_and_common_conversations(spark, monkeypatch):
    """Spans, blocks of ids and ranges that are crossed many times."""
    monkeypatch.setattr(prefix_trie, "SPAN", 3)
    monkeypatch.setattr(prefix_trie, "IDS_SHIFT", 2)
    rows = [(c, n, "u", f"t{n}") for c in (1, 2, 50) for n in range(90)] + [(2, 90, "u", "more")] + [(c, 0, "u", "hi") for c in range(300, 420)] + [(7, 3, "u", "same")] * 40
    assert trie_of(spark.createDataFrame(rows, TURNS).repartition(6)) == trie(rows)


def test_trie_empty_and_further_columns(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], TURNS)).isEmpty()
    rows = random_turns(4, range(10), 6)
    df = spark.createDataFrame(rows, TURNS)
    for name in ("x", "y", "place", "block", "t1", "level", "range", "own", "n_convs", "depth", "conv"):
        df = df.withColumn(name, F.lit(name))
    assert trie_of(df) == trie(rows)


# filter audit

DOCS = "doc_id long, text string, source string"
LABELS = "doc_id long, quality int, toxic int"


def audit(rows, labels):
    """[(doc_id, text, source)] and [(doc_id, quality, toxic)] -> the rows, by applying every order to every document."""
    id_of = lambda i: brute.LAST if i is None else i
    least = {}
    for i, t, _ in rows:
        least[t or ""] = min(id_of(i), least.get(t or "", brute.LAST))
    docs = []
    for i, t, s in rows:
        t, w = t or "", brute.words(t)
        fails = {x for x, bad in zip("ABCDE", (
            len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), re.search(r"[#$%&*|]", t) is not None, id_of(i) > least[t]
        ), strict=True) if bad}
        good, toxic = (any(j == i and i is not None and q[k] == 1 for j, *q in labels) for k in (0, 1))
        docs.append((s or "", fails, good, toxic))
    out = Counter()
    for part in {d[0] for d in docs}:
        table, removed_by = {}, Counter()
        for order in itertools.permutations("ABCDE"):
            left = [d[1:] for d in docs if d[0] == part]
            gone = []
            for step, x in enumerate(order, 1):
                now = [d for d in left if x in d[0]]
                table["".join(order), step] = (
                    len(left) - len(now), len(now), sum(x in d[0] for d in gone), sum(d[1:][0] == {x} for d in docs if d[0] == part), sum(d[1] for d in now), sum(d[2] for d in now),
                )
                removed_by[x] += len(now)
                left, gone = [d for d in left if x not in d[0]], gone + now
        out.update((part, order, step, *row, removed_by[order[step - 1]]) for (order, step), row in table.items())
    return out


def audited(docs, labels):
    return Counter(tuple(r) for r in filter_audit.audit(docs, labels).collect())


def test_audit_random_and_odd(spark):
    rng = random.Random(8)
    texts = [None, "", " \n", "short", "Mostly UPPER CASE", "a b " * 120, "a $ b " * 120, " ".join(f"w{i}" for i in range(300)), " ".join(f"w{i}" for i in range(300)) + " &", " ".join(f"W{i}" for i in range(250))]
    texts += [" ".join(rng.choice(["A", "b", "é", "|", "x" * 5]) + str(rng.randrange(400)) for _ in range(rng.randrange(100, 400))) for _ in range(10)]
    rows = [(rng.choice([None, *range(50)]), rng.choice(texts), rng.choice(["s1", "s2", "s2", "", None])) for _ in range(160)]
    rows += rows[:20]
    labels = [(rng.choice([None, *range(60)]), rng.choice([0, 1, None]), rng.choice([0, 0, 1, None])) for _ in range(50)]
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    assert audited(docs.withColumns({"part": F.lit(1), "mask": F.lit(2), "good": F.lit(3)}), spark.createDataFrame(labels, LABELS).withColumn("n", F.lit(1))) == audit(rows, labels)


def test_audit_long_text_and_empty_tables(spark):
    rows = [(1, "word " * 200_000, "s"), (2, "word " * 200_000, "s"), (3, "z" * 300_000, "s")]
    assert audited(spark.createDataFrame(rows, DOCS), spark.createDataFrame([], LABELS)) == audit(rows, [])
    assert filter_audit.audit(spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)).isEmpty()


# language identification

SPOKEN = {"en": "the of and to is that ing tion with", "de": "der die und ist nicht ein sch ung chen", "fr": "le la les est une que tion eux ais"}
TEXTS = "doc_id long, text string, lang string"


def spoken(rng, lang, n):
    parts = SPOKEN[lang].split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.choice((1, 1, 2, 3)))) for _ in range(n))


@pytest.fixture(scope="module")
def spoken_rows():
    rng = random.Random(5)
    return [(i, spoken(rng, lang, rng.randrange(5, 60)), lang) for i in range(300) for lang in [rng.choice(list(SPOKEN))]]


def plain_scores(rows):
    """A function from a word to its scores by language, with every word and n-gram in the tables."""
    learned = [(t.lower(), lang) for i, t, lang in rows if i is not None and t is not None and lang is not None and zlib.crc32(str(i).encode()) % 3 != 1]
    words, langs = defaultdict(Counter), sorted({lang for _, lang in learned})
    for t, lang in learned:
        words[lang].update(re.findall(r"[^\W\d_]+", t))
    pieces = {lang: [Counter() for _ in range(6)] for lang in langs}
    for lang in langs:
        for w in words[lang]:
            for n in range(1, 6):
                m = f" {w} " if n > 1 else w
                pieces[lang][n].update(m[k : k + n] for k in range(len(m) - n + 1))

    def of(counts, x):
        totals = {lang: max(sum(counts[lang].values()), 1) for lang in langs}
        return [math.log((counts[lang][x] / totals[lang]) or 0.5 / max(totals.values())) for lang in langs]

    def scores(w):
        if any(words[lang][w] for lang in langs):
            return of(words, w)
        for n in range(5, 0, -1):
            own = {lang: pieces[lang][n] for lang in langs}
            m = f" {w} " if n > 1 else w
            found = [of(own, m[k : k + n]) for k in range(len(m) - n + 1) if any(own[lang][m[k : k + n]] for lang in langs)]
            if found:
                return [sum(x) / len(found) for x in zip(*found, strict=True)]
        return [0.0] * len(langs)

    return langs, scores


def test_language_against_plain_version(spark, spoken_rows):
    rng = random.Random(6)
    rows = spoken_rows + [(1000 + i, "".join(rng.choice("thendscqux éß") for _ in range(40)), None) for i in range(40)] + [(2000, "Öl №5 ½ 东京 ǅ", None)]
    langs, scores = plain_scores(rows)
    for r in language_id.languages(spark.createDataFrame(rows, TEXTS)).collect():
        text = rows[r["doc_id"]][1] if r["doc_id"] < 300 else next(t for i, t, _ in rows if i == r["doc_id"])
        own = ["".join(c for c in w if c.isalpha()) for w in re.findall(r"[^\W\d_]+", text.lower())]
        own = [scores(w) for w in own if w]
        total = [sum(x) for x in zip(*own, strict=True)]
        odds = [math.exp((x - max(total)) * min(len(own), 10) / len(own)) for x in total]
        assert r["score"] == pytest.approx(1 / sum(odds), rel=1e-5)
        assert total[langs.index(r["lang_pred"])] == pytest.approx(max(total))
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)


def test_language_held_out_accuracy(spark, spoken_rows):
    got = {r["doc_id"]: r for r in language_id.languages(spark.createDataFrame(spoken_rows, TEXTS)).collect()}
    out = [(i, lang) for i, _, lang in spoken_rows if got[i]["held_out"]]
    assert sum(got[i]["lang_pred"] == lang for i, lang in out) >= 0.98 * len(out) > 60


def test_language_learns_from_texts_outside_the_fold_only(spark, spoken_rows):
    """Held-out labels, other columns and the order of rows are without effect."""
    first = {tuple(r) for r in language_id.languages(spark.createDataFrame(spoken_rows, TEXTS)).collect()}
    other = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 3 == 1 else lang) for i, t, lang in spoken_rows][::-1]
    df = spark.createDataFrame(other, TEXTS).withColumns({"source": F.lit("en"), "score": F.lit("a"), "h": F.lit(1), "word": F.lit("w"), "held_out": F.lit(0)})
    assert {tuple(r) for r in language_id.languages(df.repartition(3)).collect()} == first


def test_language_odd_rows(spark, odd_rows, spoken_rows):
    rows = [(i, t, "en") for i, t in odd_rows] + [(i + 5000, t, lang) for i, t, lang in spoken_rows] + [(9000, "12 34 ½ ²", "de"), (9001, "the und " * 200_000, "fr"), (9002, "٣٤ _ _", None)]
    got = language_id.languages(spark.createDataFrame(rows, TEXTS)).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _, _ in rows)
    for r in got:
        texts = [t for i, t, _ in rows if i == r["doc_id"]]
        assert (r["lang_pred"] == "und" and r["score"] == 0) or any(any(c.isalpha() for c in t or "") for t in texts)
        assert 0 <= r["score"] <= 1
    nothing = language_id.languages(spark.createDataFrame([(1, "the", None), (2, None, "en")], TEXTS)).collect()
    assert {(r["lang_pred"], r["score"]) for r in nothing} == {("und", 0.0)}
    assert language_id.languages(spark.createDataFrame([], TEXTS)).isEmpty()


def test_language_forgets_unknown_words_without_effect(monkeypatch):
    rng = random.Random(1)
    model = language_id.Model([("a", "the", 5), ("b", "und", 4)], [("a", "t", 3), ("b", "u", 2), ("b", "t", 1)], {"a": 9, "b": 8})
    texts = [" ".join("".join(rng.choice("tuxd") for _ in range(4)) for _ in range(200)) for _ in range(30)]
    whole = language_id.predict(texts, model, language_id.Scores(model))
    monkeypatch.setattr(language_id, "CACHE", 10)
    monkeypatch.setattr(language_id, "WORDS_AT_ONCE", 7)
    again = language_id.predict(texts, model, language_id.Scores(model))
    assert [x for x, _ in again] == [x for x, _ in whole] and [s for _, s in again] == pytest.approx([s for _, s in whole])


def test_language_words_split_in_spans_like_whole_texts(monkeypatch):
    """Words are taken some characters at a time without cutting one; digits of other scripts are dropped as before."""
    rng = random.Random(3)
    alphabet = "abcΣσéİ²½_1 .,'\n\tz"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 300))) for _ in range(200)]
    texts += ["ΟΔΟΣ'Α İSTANBUL x²y ½ a_b", "ab" * 50, ""]

    def plain(text):
        words = (m.group() for m in re.finditer(r"[^\W\d_]+", text.lower()))
        return [w for w in ("".join(c for c in word if c.isalpha()) for word in words) if w]

    monkeypatch.setattr(language_id, "SPAN", 7)
    assert [list(language_id.tokens(t)) for t in texts] == [plain(t) for t in texts]
    assert [len(words) for words in language_id.word_lists("ab cd ef gh ij")] == [3, 2]

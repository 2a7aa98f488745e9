"""Language identification by words first, and by ever shorter character n-grams for words that are not known.

A word is a run of letters in lower case. A known word, one that any language's sample holds, scores the logarithm of its
share of all words in each language; a language that lacks it scores a fixed penalty. Of an unknown word the n-grams of
MOST_N characters are looked up (a blank marks either end), and if none is known, those one shorter, down to single
characters; the word scores the mean over the n-grams that are known. A text scores the mean over its words, and the best
language is the prediction.

The model is learned from a bounded sample: the FIT_ROWS labelled rows with the smallest hashes, of texts of at most
FIT_CHARS characters. Spark counts words by language; the WORDS commonest words and the GRAMS commonest n-grams (counted
over distinct words, as unknown words are rare ones) are kept, so that the model has a fixed size. It is applied in one
pass over whole texts, without a shuffle; scores of unknown words are kept by the task for words that come again, at most
CACHE of them.

Defined results: null texts and texts without a letter are `und` with score 0; so is every text if nothing is labelled;
a text whose words and characters are all unknown goes to the commonest language of the sample; of languages that score
alike the first by name wins; rows without doc_id are not learned from and not held out; rows that repeat are treated alike;
other columns are not looked at; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm.common import read, written
from tripmill.llm.shingles import chunks

UNKNOWN = "und"
FIT_ROWS, FIT_CHARS = 20_000, 100_000
WORDS, GRAMS = 60_000, 120_000
MOST_N = 5
PENALTY = 0.5  # occurrences that a language is taken to have of what its sample lacks
SURE = 10  # words after which more words do not make a prediction surer
CACHE = 200_000
ROWS_AT_ONCE, WORDS_AT_ONCE = 1024, 1 << 18

TOKEN = re.compile(r"[^\W\d_]+")
NON_WORD = re.compile(r"[\W\d_]")
SPAN = 1 << 20  # characters of a text that are split into words at once

COUNTS = "lang string, word string, n long"
PREDICTED = "doc_id long, lang_pred string, score double"
PREDICTED_SCHEMA = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def tokens(text: str) -> Iterator[str]:
    """Words of a text; digits of other scripts that count as word characters are no letters."""
    return chain.from_iterable(word_lists(text))


def word_lists(text: str) -> Iterator[list[str]]:
    """The words of `tokens`, in lists of those of about SPAN characters at a time, cut where no word can go on."""
    lower, begin = text.lower(), 0
    while begin < len(lower):
        cut = NON_WORD.search(lower, begin + SPAN)
        end = cut.start() if cut else len(lower)
        words = TOKEN.findall(lower, begin, end)
        if words and not "".join(words).isalpha():
            words = [word for word in (w if w.isalpha() else "".join(c for c in w if c.isalpha()) for w in words) if word]
        yield words
        begin = end


def grams(word: str, n: int) -> list[str]:
    marked = f" {word} " if n > 1 else word
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


class Model:
    """Tables of words and n-grams with a score by language for each."""

    def __init__(self, words: list[tuple[str, str, int]], pieces: list[tuple[str, str, int]], totals: dict[str, float]):
        """`words` and `pieces`: (language, word or n-gram, count); `totals`: words by language in the whole sample."""
        self.langs = sorted(totals)
        self.prior = np.array([np.log(totals[lang] / sum(totals.values())) for lang in self.langs])
        self.words = self._table(words, totals)
        self.grams: dict[str, np.ndarray] = {}
        for n in range(1, MOST_N + 1):
            own = [x for x in pieces if len(x[1]) == n]
            sums = Counter()
            for lang, _, count in own:
                sums[lang] += count
            self.grams |= self._table(own, sums)

    def _table(self, counts: list[tuple[str, str, int]], totals: dict[str, float]) -> dict[str, np.ndarray]:
        at = {lang: i for i, lang in enumerate(self.langs)}
        whole = np.array([max(totals.get(lang, 0), 1) for lang in self.langs], float)
        table: dict[str, np.ndarray] = {}
        for lang, piece, count in counts:
            table.setdefault(piece, np.full(len(self.langs), PENALTY))[at[lang]] = count
        least = PENALTY / whole.max(initial=1)  # a small sample says little about what a language lacks
        return {piece: np.log(np.where(own > PENALTY, own / whole, least)) for piece, own in table.items()}

    def unknown(self, word: str) -> np.ndarray:
        """Scores of a word that no sample holds."""
        for n in range(min(MOST_N, len(word) + 2), 0, -1):
            found = [self.grams[g] for g in grams(word, n) if g in self.grams]
            if found:
                return np.add.reduce(found, axis=0) / len(found)  # np.mean, without its checks
        return np.zeros(len(self.langs))


class Scores(dict):
    """Rows of a matrix of scores by word; words that come up are added."""

    def __init__(self, model: Model):
        super().__init__({word: i for i, word in enumerate(model.words)})
        self.model, self.known = model, len(model.words)
        self.matrix = np.zeros((self.known + 1024, len(model.langs)))
        if model.words:
            self.matrix[: self.known] = list(model.words.values())

    def __missing__(self, word: str) -> int:
        at = len(self)
        if at == len(self.matrix):
            self.matrix = np.concatenate([self.matrix, np.zeros_like(self.matrix)])
        self.matrix[at] = self.model.unknown(word)
        self[word] = at
        return at

    def trimmed(self) -> None:
        """Forgets unknown words once they are many."""
        if len(self) > self.known + CACHE:
            for word in list(islice(self, self.known, None)):
                del self[word]


def predict(texts: list[str | None], model: Model, scores: Scores) -> list[tuple[str, float]]:
    out = []
    for text in texts:
        total, count = model.prior * 1e-9, 0  # decides only where all else is alike
        words = tokens(text or "") if model.langs else iter(())
        while places := list(map(scores.__getitem__, islice(words, WORDS_AT_ONCE))):
            total = total + scores.matrix[places].sum(axis=0)
            count += len(places)
            scores.trimmed()
        if not count:
            out.append((UNKNOWN, 0.0))
            continue
        best = int(np.argmax(total))
        odds = np.exp((total - total[best]) * (min(count, SURE) / count))
        out.append((model.langs[best], float(1 / odds.sum())))
    return out


def predictor(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = Scores(model)
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS_AT_ONCE):
                ids, texts = (c.to_pylist() for c in batch.slice(begin, ROWS_AT_ONCE).columns)
                found = predict(texts, model, scores)
                columns = [pa.array(ids, pa.int64()), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, schema=PREDICTED_SCHEMA)

    return run


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words by language, summed over some texts at a time."""
    for batch in batches:
        langs, texts = (c.to_pylist() for c in batch.columns)
        for a, b in chunks([len(t) for t in texts]):
            counts: Counter = Counter()
            for lang, text in zip(langs[a:b], texts[a:b], strict=True):
                counts.update((lang, word) for word in tokens(text))
            rows = [(lang, word, n) for (lang, word), n in counts.items()]
            if rows:
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64()), strict=True)], names=["lang", "word", "n"])


def learned(docs: DataFrame, *, rows: int = FIT_ROWS) -> Model:
    """The model, from rows that are not held out; `docs` has doc_id, text and lang."""
    usable = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.where(F.length("text") <= FIT_CHARS).select("lang", "text", F.xxhash64("doc_id", "text").alias("h"))
    last = usable.select("h").orderBy("h").limit(rows).agg(F.max("h").alias("last")).first()["last"]
    if last is None:
        return Model([], [], {})
    counts = usable.where(F.col("h") <= last).select("lang", "text").mapInArrow(_count, COUNTS)
    counts = written(counts.groupBy("lang", "word").agg(F.sum("n").alias("n")), "word-counts")
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    words = _commonest(counts, "word", WORDS)
    marked = F.concat(F.lit(" "), F.col("word"), F.lit(" "))
    cut = lambda text, n: F.transform(F.sequence(F.lit(1), F.length(text) - (n - 1)), lambda i: F.substring(text, i, F.lit(n)))
    pieces = [F.when(F.length(text) >= n, cut(text, n)).otherwise(F.array().cast("array<string>")) for n in range(1, MOST_N + 1) for text in [marked if n > 1 else F.col("word")]]
    own = counts.select("lang", F.explode(F.concat(*pieces)).alias("gram"))
    own = written(own.groupBy("lang", "gram").agg(F.count("*").alias("n")), "gram-counts")
    return Model(words, _commonest(own, "gram", GRAMS), totals)


def _commonest(counts: DataFrame, piece: str, most: int) -> list[tuple[str, str, int]]:
    """(language, piece, count) of the `most` commonest pieces."""
    chosen = counts.groupBy(piece).agg(F.sum("n").alias("whole")).orderBy(F.desc("whole"), piece).limit(most).select(piece)
    return [tuple(r) for r in counts.join(F.broadcast(chosen), piece).select("lang", piece, "n").collect()]


def languages(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of `docs`; the model is learned from its labelled rows if not given."""
    model = model or learned(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = rows.mapInArrow(predictor(model), PREDICTED)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(read(spark, sf_dir, "documents").select("doc_id", "text", "lang"))

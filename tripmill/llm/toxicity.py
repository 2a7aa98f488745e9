"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Labels say of documents, not of tokens, whether they are toxic. Tokens are labelled from them first: a word, or a prefix of
words, that stands in toxic documents far more often than chance allows is evidence, and its tokens in toxic documents are
labelled toxic; a toxic document without such a token gets its best one labelled. The field then learns weights of words
and prefixes and of the four transitions by gradient ascent on the likelihood of these labels.

Scoring streams over all documents: forward-backward gives each token's probability of being toxic; a logistic regression
over the largest and the sum of a document's probabilities, fitted on the same sample, gives its score. Tokens of
probability one half or more are reported by their offsets.

The sample is bounded: of the labelled rows that are not held out, the FIT_ROWS with the smallest hashes, without texts of
more than FIT_CHARS characters. Everything else covers all rows and whole texts. One task fits the sample; the driver passes
on the weights.

Defined results: null and empty texts have no tokens and get the score of a document without evidence; a document with a
null doc_id is scored and counts as not held out; without labels of both kinds, every score is the share of toxic labels
(0 without labels); equal texts have equal scores; an empty table gives an empty table.
"""

from __future__ import annotations

import pickle
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.llm.common import free_names, read
from tripmill.llm.shingles import chunks, mixed

FIT_ROWS, FIT_CHARS = 4000, 100_000
CLEAN_PER_TOXIC = 2  # documents the field is fitted on
PREFIXES = (3, 4, 5, 6, 7)
LIGHTEST = 0.02  # smaller weights are left out
ROUNDS, RATE, DECAY = 40, 0.3, 1e-4
BLOCK = 32
FIT_TOKENS = 50_000  # that are worked on at a time while fitting
THRESHOLD = 0.3
MOST_WORDS = 300_000  # that a task remembers
ROWS_AT_ONCE = 1024

TOKEN = re.compile(r"[^\W_]+")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def pieces(word: str) -> list[str]:
    """What tells of a word: itself and its prefixes."""
    return [f"={word}", *(f"^{word[:n]}" for n in PREFIXES if len(word) >= n)]


@dataclass
class Field:
    """Weights of pieces by kind, the bias and log transitions [from][to]; and the document's logistic weights."""

    words: dict[str, float] = field(default_factory=dict)
    prefixes: dict[str, float] = field(default_factory=dict)
    bias: float = 0.0
    moves: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    logistic: np.ndarray | None = None
    constant: float = 0.0


class Scores(dict):
    """Words to their score, worked out when first asked for."""

    def __init__(self, model: Field):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> float:
        if len(self) >= MOST_WORDS:
            self.clear()
        model = self.model
        score = model.bias + model.words.get(word, 0.0)
        for n in PREFIXES[: max(0, len(word) - PREFIXES[0] + 1)]:
            score += model.prefixes.get(word[:n], 0.0)
        self[word] = score
        return score


class Lattice:
    """Token sequences of some documents, cut into blocks of BLOCK tokens; the last block of each is filled up.

    Blocks of all documents advance together, so the work is a few array operations per place in a block. Arrays are
    [place in the block, block].
    """

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths
        self.blocks = -(-lengths // BLOCK)
        self.first = np.cumsum(self.blocks) - self.blocks
        self.size = int(self.blocks.sum())
        owner = np.repeat(np.arange(len(lengths)), lengths)
        place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.place = (place % BLOCK) * self.size + self.first[owner] + place // BLOCK
        self.by_size = np.argsort(-self.blocks, kind="stable")

    def carried(self, whole: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Forward values before each block and backward values after it, from the blocks' products."""
        begin, end = [np.ones(self.size), np.zeros(self.size)], [np.ones(self.size), np.ones(self.size)]
        # A document begins as after a clean token.
        w00, w01, w10, w11 = whole
        sizes = self.blocks[self.by_size]
        for k in range(int(sizes.max(initial=1)) - 1):
            docs = self.by_size[: np.searchsorted(-sizes, -(k + 1), "left")]  # those with a block after number k
            at = self.first[docs] + k
            x, y = begin[0][at] * w00[at] + begin[1][at] * w10[at], begin[0][at] * w01[at] + begin[1][at] * w11[at]
            begin[0][at + 1], begin[1][at + 1] = x / (x + y), y / (x + y)
            at = self.first[docs] + self.blocks[docs] - 1 - k
            x, y = w00[at] * end[0][at] + w01[at] * end[1][at], w10[at] * end[0][at] + w11[at] * end[1][at]
            end[0][at - 1], end[1][at - 1] = x / (x + y), y / (x + y)
        return begin, end

    def marginals(self, scores: np.ndarray, moves: np.ndarray, pairs: bool = False):
        """Each token's probability of state 1; with `pairs` also the sum of each transition's probabilities."""
        if not len(scores):
            return (np.zeros(0), np.zeros((2, 2))) if pairs else np.zeros(0)
        shape = (BLOCK, self.size)
        clean, toxic = np.exp(np.minimum(0, -scores)), np.exp(np.minimum(0, scores))  # the larger of the two is 1
        t = np.exp(moves - moves.max())
        step = []
        for a in (0, 1):
            for b, emitted in ((0, clean), (1, toxic)):  # filling moves nothing
                grid = np.full(BLOCK * self.size, float(a == b))
                grid[self.place] = t[a, b] * emitted
                step.append(grid.reshape(shape))
        m00, m01, m10, m11 = step
        w00, w01, w10, w11 = (x.copy() for x in (m00[0], m01[0], m10[0], m11[0]))
        for i in range(1, BLOCK):
            w00, w01 = w00 * m00[i] + w01 * m10[i], w00 * m01[i] + w01 * m11[i]
            w10, w11 = w10 * m00[i] + w11 * m10[i], w10 * m01[i] + w11 * m11[i]
            if i % 4 == 3:
                most = np.maximum(np.maximum(w00, w01), np.maximum(w10, w11))
                w00, w01, w10, w11 = w00 / most, w01 / most, w10 / most, w11 / most
        (f0, f1), (b0, b1) = self.carried([w00, w01, w10, w11])
        # forward[i] is before place i, as the share of state 1; backward likewise after it.
        forward = np.empty((BLOCK + 1, self.size))
        forward[0] = f1 / (f0 + f1)
        for i in range(BLOCK):
            x, y = f0 * m00[i] + f1 * m10[i], f0 * m01[i] + f1 * m11[i]
            forward[i + 1] = f1 = y / (x + y)
            f0 = 1 - f1
        backward = np.empty((BLOCK, self.size))
        for i in reversed(range(BLOCK)):
            backward[i] = share = b1 / (b0 + b1)
            b0, b1 = m00[i] * (1 - share) + m01[i] * share, m10[i] * (1 - share) + m11[i] * share
        up = forward[1:] * backward
        probability = (up / (up + (1 - forward[1:]) * (1 - backward))).ravel()[self.place]
        if not pairs:
            return probability
        before, sums = forward[:-1], []
        joint = [(1 - before) * m00 * (1 - backward), (1 - before) * m01 * backward, before * m10 * (1 - backward), before * m11 * backward]
        total = sum(joint)
        for x in joint:
            sums.append((x / total).ravel()[self.place].sum())
        return probability, np.array(sums).reshape(2, 2)


class Vocabulary:
    """Numbers of words and of their pieces, and which pieces each word has.

    Pieces are those of words in toxic documents, which are read first; others cannot tell of a toxic word. Words without
    such a piece share number 0.
    """

    def __init__(self):
        self.words: dict[str, int] = {"": 0}
        self.pieces: dict[str, int] = {}
        self.lists: list[list[int]] = [[]]

    def read(self, text: str, toxic: bool) -> np.ndarray:
        numbers = []
        for word in TOKEN.findall(text.lower()):
            number = self.words.get(word)
            if number is None:
                own = pieces(word)
                known = [self.pieces.setdefault(p, len(self.pieces)) for p in own] if toxic else [self.pieces[p] for p in own if p in self.pieces]
                number = 0
                if known:
                    number = self.words[word] = len(self.lists)
                    self.lists.append(known)
            numbers.append(number)
        return np.array(numbers, np.int64)

    def close(self) -> None:
        """To be called when all texts are read."""
        self.starts = np.cumsum([0, *map(len, self.lists)])
        self.of_words = np.array([p for own in self.lists for p in own], np.int64)
        self.owners = np.repeat(np.arange(len(self.lists)), np.diff(self.starts))
        self.is_long = np.array([len(p) > 6 for p in self.pieces], bool)
        self.lists = []

    def pieces_of(self, words: np.ndarray) -> np.ndarray:
        """Pieces of distinct words, with repetitions."""
        lengths = self.starts[words + 1] - self.starts[words]
        at = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        return self.of_words[np.repeat(self.starts[words], lengths) + at]


def families(docs: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """Number of the family of each document: toxic near copies share one, found by four minhashes of their words."""
    family = np.arange(len(docs))

    def head(i: int) -> int:
        while family[i] != i:
            family[i] = family[family[i]]
            i = family[i]
        return i

    salts = mixed(np.arange(16, dtype=np.uint64))
    first: dict[tuple[int, ...], int] = {}
    for i, words in enumerate(docs):
        if len(words) and toxic[i]:
            least = [int(mixed(words.astype(np.uint64) ^ salt).min()) for salt in salts]
            for band in range(0, 16, 4):
                j = head(first.setdefault((band, *least[band : band + 4]), i))
                family[max(head(i), j)] = min(head(i), j)
    return np.array([head(i) for i in range(len(docs))], np.int64)


def evidence(vocabulary: Vocabulary, docs: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """Which pieces mark toxic tokens.

    Copies of a toxic document say nothing new, so families are counted, each with all its words.
    """
    family = families(docs, toxic)
    heads = np.unique(family)
    docs = [np.concatenate([docs[i] for i in np.flatnonzero(family == h)]) for h in heads]
    toxic = np.array([toxic[family == h].any() for h in heads], bool)
    seen, hits = [np.zeros(len(vocabulary.pieces), np.int64) for _ in range(2)]
    for words, label in zip(docs, toxic, strict=True):
        own = np.unique(vocabulary.pieces_of(np.unique(words)))
        seen[own] += 1
        if label:
            hits[own] += 1
    rate = toxic.mean()
    # Of the pieces in n or more documents, a share of rate ** n stands in toxic ones only by chance; a thousandth of one may.
    at_least = np.cumsum(np.bincount(seen)[::-1])[::-1]
    needed = next((n for n in range(1, len(at_least)) if at_least[n] * rate**n < 1e-3), len(at_least))
    # Long pieces may also come up in clean documents, by chance syllables.
    pure = (hits > 0) & (hits >= np.where(vocabulary.is_long, 0.8, 0.98) * seen)
    marks = pure & (hits >= needed)
    left = [own for own in (vocabulary.pieces_of(np.unique(w)) for w, label in zip(docs, toxic, strict=True) if label) if not marks[own].any()]
    while left:  # the pure piece that most words of those left share
        gain = np.bincount(np.concatenate(left), minlength=len(marks)) * pure
        best = int(np.lexsort((hits, gain))[-1])
        if gain[best] < 2:
            break
        marks[best] = True
        left = [own for own in left if best not in own]
    return marks


def fitted(texts: list[str], labels: list[int]) -> Field:
    toxic = np.array(labels, bool)
    model = Field(constant=float(toxic.mean()) if len(toxic) else 0.0)
    if not toxic.any() or toxic.all():
        return model
    vocabulary = Vocabulary()
    docs: list[np.ndarray] = [np.zeros(0, np.int64)] * len(texts)
    for i in [*np.flatnonzero(toxic), *np.flatnonzero(~toxic)]:
        docs[i] = vocabulary.read(texts[i], bool(toxic[i]))
    vocabulary.close()
    marks = evidence(vocabulary, docs, toxic)
    row, column, words = vocabulary.owners, vocabulary.of_words, len(vocabulary.starts) - 1
    marked = np.bincount(row, marks[column], words) > 0

    clean = np.flatnonzero(~toxic)[: CLEAN_PER_TOXIC * int(toxic.sum())]
    chosen = [*np.flatnonzero(toxic), *clean]
    ids = np.concatenate([docs[i] for i in chosen])
    target = np.concatenate([marked[docs[i]] & toxic[i] for i in chosen]).astype(float)
    lengths = np.array([len(docs[i]) for i in chosen])
    begin = np.concatenate([[0], np.cumsum(lengths)])
    parts = [(begin[a], begin[b], Lattice(lengths[a:b])) for a, b in chunks(list(lengths), FIT_TOKENS)]
    starts = np.zeros(len(ids), bool)
    starts[begin[:-1][lengths > 0]] = True
    held = np.concatenate([[0.0], target[:-1]])
    held[starts] = 0
    seen_moves = np.array([[np.sum((held == a) & (target == b)) for b in (0, 1)] for a in (0, 1)], float)

    n = len(vocabulary.pieces)
    mean, square, value = np.zeros(n + 5), np.zeros(n + 5), np.zeros(n + 5)  # pieces, bias, transitions
    value[n] = -4.0
    scale = max(1.0, target.sum())
    for turn in range(1, ROUNDS + 1):
        word_scores = np.bincount(row, value[column], words) + value[n]
        moves = value[n + 1 :].reshape(2, 2)
        probability, expected = np.empty(len(ids)), np.zeros((2, 2))
        for a, b, lattice in parts:
            probability[a:b], moved = lattice.marginals(word_scores[ids[a:b]], moves, pairs=True)
            expected += moved
        by_word = np.bincount(ids, probability - target, words)
        slope = np.concatenate([np.bincount(column, by_word[row], n), [by_word.sum()], (expected - seen_moves).ravel()])
        slope = slope / scale + DECAY * value
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2  # Adam
        value = value - RATE * (mean / (1 - 0.9**turn)) / (np.sqrt(square / (1 - 0.99**turn)) + 1e-6)
    by_kind = {"=": model.words, "^": model.prefixes}
    for piece, i in vocabulary.pieces.items():
        if abs(value[i]) >= LIGHTEST:
            by_kind[piece[0]][piece[1:]] = float(value[i])
    model.bias, model.moves = float(value[n]), value[n + 1 :].reshape(2, 2).copy()

    word_scores = np.bincount(row, value[column], words) + value[n]
    sums = []
    for a, b in chunks([len(own) for own in docs], FIT_TOKENS):
        sums.append(summaries([len(own) for own in docs[a:b]], word_scores[np.concatenate(docs[a:b])], model)[0])
    model.logistic = logistic(np.concatenate(sums), toxic.astype(float))
    return model


def summaries(lengths: list[int], scores: np.ndarray, model: Field) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each document what its score is made of; all tokens' probabilities, and where each document's begin."""
    lengths = np.array(lengths, np.int64)
    probability = Lattice(lengths).marginals(scores, model.moves)
    begin = np.cumsum(lengths) - lengths
    full = lengths > 0
    out = np.tile([1.0, np.log(1e-4), np.log(1e-2)], (len(lengths), 1))
    if full.any():
        out[full, 1] = np.log(np.maximum.reduceat(probability, begin[full]) + 1e-4)
        out[full, 2] = np.log(np.add.reduceat(np.where(probability > 0.05, probability, 0), begin[full]) + 1e-2)
    return out, probability, begin


def logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Newton steps with a small penalty; weights of evidence do not go below 0."""
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(len(w))
        w = w - np.linalg.solve(hessian, x.T @ (p - y) + 0.05 * w)
    w[1:] = np.maximum(w[1:], 0)
    return w


def scorer(model: Field, text_at: int, names: list[str]):
    """Adds score and spans to the rows of a batch."""

    def added(own: list[str]) -> tuple[list[float], list[list]]:
        spans: list[list] = [[] for _ in own]
        if model.logistic is None:
            return [model.constant] * len(own), spans
        words_of = [TOKEN.findall(t.lower()) for t in own]
        scores = np.array([known[w] for words in words_of for w in words], float)
        sums, probability, begin = summaries([len(words) for words in words_of], scores, model)
        hit = np.flatnonzero(probability >= 0.5)
        for at, i in zip(hit.tolist(), (np.searchsorted(begin, hit, "right") - 1).tolist(), strict=True):
            spans[i].append(at - begin[i])
        for i, places in enumerate(spans):
            if places:
                wanted = set(places)
                spans[i] = [{"start": m.start(), "length": m.end() - m.start()} for n, m in enumerate(TOKEN.finditer(own[i].lower())) if n in wanted]
        return (1 / (1 + np.exp(-np.clip(sums @ model.logistic, -30, 30)))).tolist(), spans

    known = Scores(model)
    span = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS_AT_ONCE):
                rows = batch.slice(begin, ROWS_AT_ONCE)
                texts = [t or "" for t in rows.column(text_at).to_pylist()]
                for a, b in chunks([len(t) for t in texts]):
                    scores, spans = added(texts[a:b])
                    columns = [*rows.slice(a, b - a).columns, pa.array(scores, pa.float64()), pa.array(spans, span)]
                    yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *names])

    return score


def sample(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """text and toxic of the bounded sample, in order; of several labels of one doc_id the largest counts."""
    usable = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    texts = docs.where(F.length("text") <= FIT_CHARS).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    order = F.xxhash64("doc_id")
    chosen = usable.join(texts.select("doc_id").distinct(), "doc_id").orderBy(order, "doc_id").limit(rows)
    found = texts.join(F.broadcast(chosen), "doc_id").orderBy(order, "doc_id", "text").limit(rows)
    return found.select("text", (F.col("toxic") > 0).cast("int").alias("toxic"))


def fit_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    texts, labels = [], []
    for batch in batches:
        texts += batch.column(0).to_pylist()
        labels += batch.column(1).to_pylist()
    yield pa.RecordBatch.from_pydict({"model": [pickle.dumps(vars(fitted(texts, labels)))]}, schema=pa.schema([("model", pa.binary())]))


def learned(docs: DataFrame, labels: DataFrame) -> Field:
    """The model, fitted by one task on the bounded sample."""
    found = sample(docs, labels).coalesce(1).mapInArrow(fit_task, "model binary").first()
    return Field(**pickle.loads(found["model"])) if found else Field()


def toxicity(docs: DataFrame, labels: DataFrame, *, carried: list[str] | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted and spans (start and length in characters) of every row of `docs`.

    With `carried`, these columns of `docs` come first instead of doc_id; those that have the name of a result are left out.
    """
    model = learned(docs, labels)
    results = ("held_out", "score", "predicted", "spans")
    kept = [F.col(f"`{name}`") for name in carried or ["doc_id"] if name not in results]
    identity, text, score, spans = free_names(docs.columns, "_doc_id", "_text", "_score", "_spans")
    rows = docs.select(*kept, F.col("doc_id").alias(identity), F.col("text").cast("string").alias(text))
    schema = T.StructType([*rows.schema.fields, *T.StructType.fromDDL(f"{score} double, {spans} array<struct<start:int,length:int>>").fields])
    scored = rows.mapInArrow(scorer(model, len(rows.columns) - 1, [score, spans]), schema)
    return scored.select(*kept, held_out(F.col(identity)).alias("held_out"), F.col(score).alias("score"), (F.col(score) >= THRESHOLD).cast("int").alias("predicted"), F.col(spans).alias("spans"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))

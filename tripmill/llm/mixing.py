"""Mixing to target weights with soft membership.

A naive Bayes classifier over hashed words, learned from labelled documents, gives every document a posterior over the
domains; labels are not looked at when it is applied. A document with t words counts t times its posterior for each domain.
Rates, the expected numbers of copies of each document, are fitted by least squares, so that rate-weighted domain totals
match the targets: the sum of (total - target) ** 2 / size over domains, where size is the domain's total at rate 1.
Projected gradient descent does it: a step lowers the rate of a document by its posterior times the relative excess of
each domain, and no rate falls below LEAST. In the metric that weighs documents by their words and domains by their sizes,
the matrix of the problem is stochastic, so steps of length 1 converge.

Posteriors are kept in per cent, so documents with equal posteriors share a rate and the descent runs over their totals, at
most some 180 000 rows for four domains, however many documents there are. The driver sees a few rows of domain totals and
the counts of the classifier. The rate of a document is found by replaying the steps on its posterior.

A document is taken floor(rate + u) times, u being a number from 0 to 1 that follows from its id and text.

Defined results: a document without words has the prior as posterior, counts for nothing, and gets the rate of its
posterior; rows without a label, or with a domain that has no target, teach nothing; without any labelled row every
posterior is even; a domain with a target but no words can't be filled and is left out of the fit; rows that repeat are
treated alike; an empty table gives an empty table.
"""

from __future__ import annotations

import math
import warnings
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm.common import dropped, free_names, read, words, written
from tripmill.llm.line_dedup import identified

BUCKETS = 4096
FIT_ROWS = 20_000  # labelled rows with the smallest hashes that the classifier learns from
TEMPER = 50  # words; the evidence of longer texts counts as that of so many, which keeps membership soft
CLOSE = 1e-6  # of a domain's size: targets that are met so closely are met
SETTLED = 1e-9  # share of the squared distance that a step must gain, or rates are as near as they come
FORESEEN, MOST_FORESEEN, MOST_ROUNDS = 8, 32, 40  # steps at a time, and times; a warning tells if targets are missed then
ROOM = 1.01  # of the least total for which no domain is over its target: at 1 a domain's target could only just be met

TARGETS = {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}


@dataclass
class Classifier:
    domains: list[str]
    priors: list[float]  # logarithms
    weights: list[list[float]]  # by domain, logarithms of word bucket shares


def _bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


def _numbers(values: list[float]) -> Column:
    """A constant array."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")


def fitted(labelled: DataFrame, domains: list[str], *, text: str = "text", domain: str = "domain", doc_id: str = "doc_id") -> Classifier:
    known = labelled.where(F.col(domain).isin(domains)).select(F.col(domain).alias("domain"), F.col(text).alias("text"), F.xxhash64(F.col(doc_id), F.col(text)).alias("h"))
    smallest = known.select("h").orderBy("h").limit(FIT_ROWS).agg(F.max("h").alias("most")).first()["most"]
    sample = known.where(F.col("h") <= smallest) if smallest is not None else known.limit(0)
    rows = sample.select("domain", F.explode(words(F.col("text"))).alias("word"))
    counts = rows.groupBy("domain", _bucket(F.col("word")).alias("bucket")).agg(F.count("*").alias("n")).collect()  # BUCKETS by domain at most
    docs = {r["domain"]: r["n"] for r in sample.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    table = {d: [0.5] * BUCKETS for d in domains}
    for r in counts:
        table[r["domain"]][r["bucket"]] += r["n"]
    total = sum(docs.values()) + len(domains)
    weights = [[math.log(x / sum(table[d])) for x in table[d]] for d in domains]
    return Classifier(domains, [math.log((docs.get(d, 0) + 1) / total) for d in domains], weights)


def membership(rows: DataFrame, model: Classifier) -> DataFrame:
    """key, n_words and percents (the posterior of each domain in per cent) of every row of (key, text).

    Words are scored as rows of their own and summed by row before anything is shuffled.
    """
    numbered = rows.withColumn("number", F.monotonically_increasing_id())
    numbered = numbered.select("number", "key", F.explode_outer(words(F.col("text"))).alias("word"))
    numbered = numbered.select("number", "key", "word", _bucket(F.col("word")).alias("bucket"))
    scored = numbered.select("number", "key", "word", *(F.get(_numbers(w), F.col("bucket")).alias(f"s{i}") for i, w in enumerate(model.weights)))
    sums = scored.groupBy("number", "key").agg(F.count("word").alias("n_words"), *(F.coalesce(F.sum(f"s{i}"), F.lit(0.0)).alias(f"s{i}") for i in range(len(model.domains))))
    temper = F.lit(float(TEMPER)) / F.greatest(F.lit(float(TEMPER)), F.col("n_words").cast("double"))
    sums = sums.select("key", "n_words", F.array(*(F.lit(prior) + temper * F.col(f"s{i}") for i, prior in enumerate(model.priors))).alias("s"))
    odds = sums.select("key", "n_words", F.transform("s", lambda x: F.exp(x - F.array_max(F.col("s")))).alias("e"))
    whole = odds.withColumn("w", F.aggregate("e", F.lit(0.0), lambda a, x: a + x))
    return whole.select("key", "n_words", F.transform("e", lambda e: F.round(100 * e / F.col("w")).cast("int")).alias("percents"))


def _posterior(percents: Column, size: int) -> list[Column]:
    whole = sum((F.get(percents, F.lit(i)) for i in range(1, size)), F.get(percents, F.lit(0)))
    return [F.get(percents, F.lit(i)) / whole for i in range(size)]


def _rate(percents: Column, size: int, steps: list[list[float]], least: float) -> Column:
    """The rate after all steps."""
    start = F.lit(max(1.0, least))
    return _after(steps, start, _posterior(percents, size), least) if steps else start


def _after(steps: list[list[float]], rate: Column, posterior: list[Column], least: float) -> Column:
    """A rate after further steps: each lowers it by the posterior times the step, and never below `least`."""
    size = len(posterior)
    flat = _numbers([x for step in steps for x in step])
    lowered_by = lambda j: sum(p * F.get(flat, j * size + i) for i, p in enumerate(posterior))
    return F.aggregate(F.sequence(F.lit(0), F.lit(len(steps) - 1)), rate, lambda r, j: F.greatest(F.lit(least), r - lowered_by(j)))


def fitted_steps(members: DataFrame, weights: list[float], least: float, total: float | None) -> list[list[float]]:
    """Steps of the descent, run until the targets are met or no step brings them nearer; `members` has n_words and percents.

    Totals change linearly as long as no rate comes to its bound. So the totals and their change by the free rates are
    summed once for several steps to come, which the driver foresees from these few numbers. Where the next sums show that
    rates came to their bound meanwhile, fewer steps are foreseen at a time, down to one.
    """
    n = len(weights)
    start = max(1.0, least)
    cells = members.where("n_words > 0").groupBy("percents").agg(F.sum("n_words").alias("n_words"))
    cells = written(cells.select(*(p.alias(f"p{i}") for i, p in enumerate(_posterior(F.col("percents"), n))), "n_words", F.lit(start).alias("rate")), "cells")
    domains = range(n)

    def sums(of: dict[str, Column]) -> dict[str, float]:
        row = cells.agg(*(F.sum(F.col("n_words") * c).alias(name) for name, c in of.items())).first()
        return {name: row[name] or 0.0 for name in of}

    def totals() -> list[float]:
        found = sums({f"d{i}": F.col(f"p{i}") * F.col("rate") for i in domains})
        return [found[f"d{i}"] for i in domains]

    held = totals()
    sizes = [x / start for x in held]
    there = [i for i in domains if sizes[i] > 0 and weights[i] > 0]
    if not there:
        dropped(cells)
        return []
    share = sum(weights[i] for i in there)
    if total is None:  # hardly more words than leave no domain with less than `least` of its own
        total = ROOM * max(least * sizes[i] * share / weights[i] for i in there) if least > 0 else sum(sizes)
    targets = [total * weights[i] / share if i in there else 0.0 for i in domains]
    excess_of = lambda held: [(held[i] - targets[i]) / sizes[i] if sizes[i] > 0 else 0.0 for i in domains]
    far = lambda e: sum(x * x * s for x, s in zip(e, sizes, strict=True))
    steps: list[list[float]] = []
    ahead = FORESEEN
    for _ in range(MOST_ROUNDS):
        excess = excess_of(held)
        if max(map(abs, excess)) < CLOSE:
            break
        falls_by = sum(F.col(f"p{i}") * excess[i] for i in domains)
        free = F.when(F.col("rate") - falls_by > least, 1.0).otherwise(0.0)
        found = sums({f"m{i}_{j}": free * F.col(f"p{i}") * F.col(f"p{j}") for i in domains for j in range(i, n)})
        change = [[found[f"m{min(i, j)}_{max(i, j)}"] for j in domains] for i in domains]
        foreseen, coming = list(held), []
        while len(coming) < ahead:
            step = excess_of(foreseen)
            if max(map(abs, step)) < CLOSE / 10:
                break
            coming.append(step)
            foreseen = [foreseen[i] - sum(change[i][j] * step[j] for j in domains) for i in domains]
        posterior = [F.col(f"p{i}") for i in domains]
        before, cells = cells, written(cells.withColumn("rate", _after(coming, F.col("rate"), posterior, least)), "cells")
        dropped(before)
        steps += coming
        held = totals()
        gained = far(excess) - far(excess_of(held))
        as_foreseen = max(abs(a - b) / s for a, b, s in zip(held, foreseen, sizes, strict=True) if s > 0) < CLOSE
        if gained <= SETTLED * far(excess) and (as_foreseen or len(coming) == 1):
            break
        ahead = min(2 * ahead, MOST_FORESEEN) if as_foreseen else max(1, ahead // 2) if gained > 0 else 1
    dropped(cells)
    if (missed := max(map(abs, excess_of(held)))) >= CLOSE:
        warnings.warn(f"after {len(steps)} steps a domain is {missed:.1e} of its size off its target", stacklevel=2)
    return steps


def mixed(
    docs: DataFrame, labelled: DataFrame, targets: dict[str, float], *, text: str = "text", domain: str = "domain", doc_id: str = "doc_id", least: float = 0.0, total: float | None = None
) -> DataFrame:
    """`docs` with n_words, percents (posterior by domain, in the order of `targets`), rate and copies, which replace any of these names."""
    domains = list(targets)
    model = fitted(labelled, domains, text=text, domain=domain, doc_id=doc_id)
    order, row = identified(docs, text, doc_id)
    members = written(membership(docs.select(row.alias("key"), F.col(text).alias("text")), model), "members")
    steps = fitted_steps(members, [targets[d] for d in domains], least, total)
    rated = members.dropDuplicates(["key"]).withColumn("rate", _rate(F.col("percents"), len(domains), steps, least))
    chance = F.pmod(F.xxhash64(F.lit("mix"), F.col(doc_id), F.col(text)), F.lit(1 << 30)) / float(1 << 30)
    key, part = free_names(docs.columns, "_key", "_chance")
    rows = docs.withColumns({key: row, part: chance}).drop("n_words", "percents", "rate", "copies")
    rows = rows.join(rated.withColumnRenamed("key", key), key)
    return rows.withColumn("copies", F.floor(F.col("rate") + F.col(part)).cast("int")).drop(key, part)


def labelled_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Of the documents that have a row in `labels` the FIT_ROWS with the smallest hashes of their ids; domain: language."""
    known = labels.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS)
    return docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", F.col("lang").alias("domain"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    labelled = labelled_documents(docs, read(spark, sf_dir, "labels"))
    out = mixed(docs.select("doc_id", "source", "text"), labelled, TARGETS)
    return out.select("doc_id", "source", "n_words", F.array_join("percents", ",").alias("percents"), "rate", "copies")

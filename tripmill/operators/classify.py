"""Classify rows as valid, invalid or quarantined.

Invalid means a rule is broken. Quarantined means a critical column is null, or the row is
clean but a repeated copy or an outlier. A row with a null and a broken rule is in both
sets, so the classes are predicates on a row, not one label.

Only the repeated copies need other rows to be known. That exchange is kept to clean rows
without any null (others are never duplicates); all else is decided where a row is read.

``measured`` narrows it further in two phases: a 64-bit digest of every such row is exchanged
and counted, then only rows whose digest came up more than once are exchanged whole. A digest
that two different rows share costs a row's exchange and changes no result, as rows are
compared by all columns in the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tripmill.functions.measures import share
from tripmill.operators.copies import fold_copies, unfold_copies
from tripmill.operators.rules import TRIPS, QualityProfile, any_null

COPIES = "_copies"
NUMBER = "_number"
DIGEST = "_digest"
REPEATED = "_repeated"
ALONE = "_alone"
MOST_DIGESTS = 200_000  # repeated digests that are broadcast, 8 bytes each; with more, whole rows are exchanged


class Classification:
    def __init__(
        self, rows: DataFrame, profile: QualityProfile = TRIPS, repeated: list[int] | None = None
    ):
        """``repeated`` are the digests that came up more than once; see ``measured``."""
        self.rows = rows
        self.profile = profile
        self.columns = rows.columns
        self.repeated = repeated
        if repeated:
            spark = rows.sparkSession
            self._known = spark.createDataFrame([(d, True) for d in repeated], f"{DIGEST} bigint, {REPEATED} boolean")

    def measured(self, most: int = MOST_DIGESTS) -> Classification:
        """The same classification after one job that counted digests of the possible duplicates.

        Where more than ``most`` digests are repeated, whole rows are exchanged as without it.
        """
        strict = self.rows.where(self._clean() & ~any_null(self.columns))
        counted = strict.groupBy(F.xxhash64(*self.columns).alias(DIGEST)).count()
        found = counted.where("count > 1").select(DIGEST).limit(most + 1).collect()
        if len(found) > most:
            return Classification(self.rows, self.profile)
        return Classification(self.rows, self.profile, [row[0] for row in found])

    def _marked(self) -> DataFrame:
        """Rows with ``_alone``: true where no other row can be a clean copy."""
        if self.repeated is None:
            return self.rows.withColumn(ALONE, any_null(self.columns))
        if not self.repeated:
            return self.rows.withColumn(ALONE, F.lit(True))
        digested = self.rows.withColumn(DIGEST, F.xxhash64(*self.columns))
        alone = any_null(self.columns) | F.col(REPEATED).isNull()
        return digested.join(F.broadcast(self._known), DIGEST, "left").select(*self.columns, alone.alias(ALONE))

    # Row flags

    def flags(self) -> DataFrame:
        """All rule flags and row-level categories as columns, in one projection."""
        return _flagged(self.rows, self.profile)

    # Row sets

    def invalid(self) -> DataFrame:
        return self.rows.where(self.profile.broken()).withColumn(
            "violation_reasons", self.profile.reasons()
        )

    def nulls(self) -> DataFrame:
        return self.rows.where(self.profile.missing())

    def _clean(self) -> Column:
        return ~self.profile.missing() & ~self.profile.broken()

    def _folded_candidates(self) -> DataFrame:
        """Clean rows that may have copies, folded.

        Unfolding reads this twice, for few and for many copies, from one exchange.
        """
        candidates = self._marked().where(self._clean() & ~F.col(ALONE))
        return fold_copies(candidates.select(*self.columns), COPIES)

    def _numbered_candidates(self, keep: Column | None = None) -> DataFrame:
        """Candidates one by one; copy number 1 is the first of its kind."""
        folded = self._folded_candidates()
        return unfold_copies(folded if keep is None else folded.where(keep), COPIES, NUMBER)

    def duplicates(self) -> DataFrame:
        """Copies of a clean row after its first one."""
        repeated = self._numbered_candidates(F.col(COPIES) > 1)
        return repeated.where(F.col(NUMBER) > 1).drop(NUMBER)

    def _clean_once(self, keep: Column) -> DataFrame:
        """Clean rows without their repeated copies."""
        candidates = self._folded_candidates().drop(COPIES)
        others = self._marked().where(self._clean() & F.col(ALONE)).select(*self.columns)
        return candidates.where(keep).unionByName(others.where(keep))

    def outliers(self) -> DataFrame:
        return self._clean_once(self.profile.outlier())

    def valid(self) -> DataFrame:
        return self._clean_once(~self.profile.outlier())

    def quarantined(self) -> DataFrame:
        reason = "quarantine_reason"
        missing, far = self.profile.missing(), self.profile.outlier()
        in_place = self._marked().where(missing | (self._clean() & F.col(ALONE) & far)).select(*self.columns)
        why = F.when(missing, F.lit("null")).otherwise(F.lit("outlier"))
        repeat = F.col(NUMBER) > 1
        numbered = self._numbered_candidates((F.col(COPIES) > 1) | far).where(repeat | far)
        label = F.when(repeat, F.lit("duplicate")).otherwise(F.lit("outlier"))
        return in_place.withColumn(reason, why).unionByName(
            numbered.withColumn(reason, label).drop(NUMBER)
        )

    def outcomes(self) -> DataFrame:
        """Every classified row with ``class``, ``violation_reasons``, ``quarantine_reason``.

        A row that is both invalid and quarantined appears in both classes. Rows that cannot
        be duplicates are labelled where they are read.
        """
        repeat, far = F.col(NUMBER) > 1, self.profile.outlier()
        why = F.when(repeat, F.lit("duplicate")).when(far, F.lit("outlier"))
        label = F.when(why.isNull(), F.lit("valid")).otherwise(F.lit("quarantined"))
        numbered = self._numbered_candidates().select(*self.columns, *_outcome(label, None, why))
        return self._labelled_in_place().unionByName(numbered)

    def _labelled_in_place(self) -> DataFrame:
        flagged = _flagged(self._marked(), self.profile).where(F.col("is_invalid") | F.col(ALONE))
        clean = ~F.col("is_null") & ~F.col("is_invalid")
        reasons = self.profile.reasons()
        held_back = F.col("is_null") | (clean & F.col("is_outlier"))
        why = F.when(F.col("is_null"), F.lit("null")).otherwise(F.lit("outlier"))
        kept = clean & ~F.col("is_outlier")
        classes = F.array(
            F.struct(*_outcome(F.when(F.col("is_invalid"), F.lit("invalid")), reasons, None)),
            F.struct(*_outcome(F.when(held_back, F.lit("quarantined")), None, why)),
            F.struct(*_outcome(F.when(kept, F.lit("valid")), None, None)),
        )
        # Rows without copies may be most of the table: they stay where they are.
        return flagged.select(*self.columns, F.inline(classes)).where("class is not null")

    # Totals

    def row_profile(self) -> DataFrame:
        """The part of the report that needs no exchange: one narrow scan, no duplicates."""
        return self.flags().agg(*self._row_totals())

    def _row_totals(self) -> list[Column]:
        return [
            F.expr("count(1) as total_rows"),
            F.expr("count_if(is_invalid) as invalid_rows"),
            F.expr("count_if(is_null) as `null`"),
            F.expr("count_if(is_null and is_invalid) as null_and_invalid_rows"),
            *(F.expr(f"count_if({r.name}) as {r.name}") for r in self.profile.rules),
            *(F.expr(f"count_if({c} is null) as null_{c}") for c in self.profile.required),
            *_extremes(self.profile.ranges),
        ]

    def _totals(self) -> DataFrame:
        """One flat row. Rows that cannot be duplicates are counted where they are read."""
        loose = _flagged(self._marked(), self.profile).withColumn(
            "_loose", ~F.expr("is_null or is_invalid") & F.col(ALONE)
        )
        in_place = loose.agg(
            *self._row_totals(),
            F.expr("count_if(_loose and not is_outlier) as loose_valid"),
            F.expr("count_if(_loose and is_outlier) as loose_outlier"),
        )
        folded = self._folded_candidates().withColumn("is_outlier", self.profile.outlier())
        groups = folded.agg(
            F.expr(f"sum({COPIES} - 1) as duplicate"),
            F.expr("count_if(not is_outlier) as strict_valid"),
            F.expr("count_if(is_outlier) as strict_outlier"),
        )
        both = in_place.unionByName(groups, allowMissingColumns=True)
        counted = [c for c in both.columns if not c.startswith(("min_", "max_"))]
        merged = both.agg(
            *(F.expr(f"coalesce(max(`{c}`), 0L) as `{c}`") for c in counted),
            *(F.max(c).alias(c) for c in both.columns if c not in counted),
        )
        return merged.withColumns(
            {
                "valid_rows": F.expr("loose_valid + strict_valid"),
                "outlier": F.expr("loose_outlier + strict_outlier"),
                "quarantined_rows": F.expr("`null` + duplicate + loose_outlier + strict_outlier"),
            }
        )

    def counts(self) -> DataFrame:
        """One row: totals per class, per quarantine category and per rule."""
        return self._totals().select(
            "total_rows",
            "valid_rows",
            "invalid_rows",
            "quarantined_rows",
            F.col("null").alias("null_rows"),
            F.col("duplicate").alias("duplicate_rows"),
            F.col("outlier").alias("outlier_rows"),
            "null_and_invalid_rows",
            *(rule.name for rule in self.profile.rules),
        )

    def report(self) -> DataFrame:
        """One nested row: the quality report of the table."""
        return nest_report(self._totals(), self.profile)

    def gate(self, max_invalid_ratio: float, max_null_ratio: float) -> DataFrame:
        """One row: the two ratios, their limits and whether the table passes."""
        return gate_row(self.row_profile(), max_invalid_ratio, max_null_ratio)


def _flagged(rows: DataFrame, profile: QualityProfile) -> DataFrame:
    flags = [f"{rule.flag} as {rule.name}" for rule in profile.rules]
    broken = " or ".join(rule.name for rule in profile.rules)
    named = rows.selectExpr("*", *flags, f"{broken} as is_invalid")
    return named.withColumns({"is_null": profile.missing(), "is_outlier": profile.outlier()})


def gate_row(profile: DataFrame, max_invalid_ratio: float, max_null_ratio: float) -> DataFrame:
    """Ratios over the totals of a one-row profile; a limit is broken only when exceeded."""
    ratios = profile.select(
        "total_rows",
        "invalid_rows",
        F.col("null").alias("null_rows"),
        share(F.col("invalid_rows"), F.col("total_rows")).alias("invalid_ratio"),
        share(F.col("null"), F.col("total_rows")).alias("null_ratio"),
    )
    return ratios.withColumn(
        "passed",
        (F.col("invalid_ratio") <= max_invalid_ratio) & (F.col("null_ratio") <= max_null_ratio),
    )


def nest_report(flat: DataFrame, profile: QualityProfile = TRIPS) -> DataFrame:
    """Shape flat report columns into the nested report row."""
    categories = ("null", "duplicate", "outlier")
    return flat.select(
        "total_rows",
        "valid_rows",
        "invalid_rows",
        (F.col("null") + F.col("duplicate") + F.col("outlier")).alias("quarantined_rows"),
        F.struct(*(F.col(f"null_{c}").alias(c) for c in profile.required)).alias("null_counts"),
        F.col("duplicate").alias("duplicate_count"),
        F.struct(*(F.col(r.name) for r in profile.rules)).alias("error_categories"),
        F.struct(*(F.col(c) for c in categories)).alias("quarantine_categories"),
        F.struct(
            *(
                F.struct(F.col(f"min_{c}").alias("min"), F.col(f"max_{c}").alias("max")).alias(c)
                for c in profile.ranges
            )
        ).alias("numeric_minmax"),
    )


def _outcome(label: Column, violation: Column | None, quarantine: Column | None) -> list[Column]:
    no_text = F.lit(None).cast("string")
    return [
        label.alias("class"),
        (no_text if violation is None else violation).alias("violation_reasons"),
        (no_text if quarantine is None else quarantine).alias("quarantine_reason"),
    ]


def _extremes(columns: tuple[str, ...]) -> list[Column]:
    return [
        F.expr(f"{bound}(cast({name} as double)) as {bound}_{name}")
        for name in columns
        for bound in ("min", "max")
    ]

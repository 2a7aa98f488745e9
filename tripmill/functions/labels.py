"""Code to label lookups as constant map expressions (no join, no UDF)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

from tripmill.schema import PAYMENT_LABELS, UNKNOWN_LABEL, WEATHER_LABELS


def label_for(code: Column, labels: dict[int, str], default: str = UNKNOWN_LABEL) -> Column:
    """Label of an integer code; unlisted and null codes get the default."""
    entries = chain.from_iterable(
        (F.lit(key).cast("bigint"), F.lit(label)) for key, label in labels.items()
    )
    found = F.try_element_at(F.create_map(*entries), code.cast("bigint"))
    return F.coalesce(found, F.lit(default))


def payment_label(code: Column) -> Column:
    return label_for(code, PAYMENT_LABELS)


def weather_label(code: Column) -> Column:
    return label_for(code, WEATHER_LABELS)

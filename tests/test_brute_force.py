"""Classification of random rows against plain Python."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from conftest import CANONICAL

from tripmill.operators.classify import Classification
from tripmill.operators.rules import TRIP_RULES

NAMES = [part.split()[0] for part in CANONICAL.split(", ")]


def random_row(rnd: random.Random) -> tuple:
    pickup = datetime(2025, 1, 1, rnd.randrange(3))
    dropoff = pickup + timedelta(seconds=rnd.choice([-1, 0, 600, 86_400, 86_401]))
    row = (
        pickup,
        dropoff,
        rnd.choice([None, -1, 0, 9, 10]),
        rnd.choice([-0.5, 0.0, 200.0, 200.5]),
        rnd.choice([0, 1, 265, 266]) if rnd.random() < 0.3 else 100,
        rnd.choice([0, 1, 265, 266]) if rnd.random() < 0.3 else 200,
        rnd.choice([0, 6, 7, -1]) if rnd.random() < 0.3 else 1,
        rnd.choice([-2.5, 10.0]) if rnd.random() < 0.3 else 10.0,
        rnd.choice([-2.5, 1.0]) if rnd.random() < 0.3 else 1.0,
    )
    if rnd.random() < 0.1:
        gap = rnd.randrange(len(row))
        row = row[:gap] + (None,) + row[gap + 1 :]
    return row


def broken_rules(row: tuple) -> list[str]:
    pickup, dropoff, riders, miles, start, end, code, fare, tip = row
    found = {
        "dropoff_before_pickup": None not in (pickup, dropoff) and dropoff < pickup,
        "negative_distance": miles is not None and miles < 0,
        "negative_fare": fare is not None and fare < 0,
        "negative_tip": tip is not None and tip < 0,
        "invalid_passenger_count": riders is not None and not 0 <= riders <= 9,
        "invalid_pickup_location": start is not None and not 1 <= start <= 265,
        "invalid_dropoff_location": end is not None and not 1 <= end <= 265,
        "invalid_payment_type": code is not None and code not in range(7),
    }
    return [rule.name for rule in TRIP_RULES if found[rule.name]]


def expected(rows: list[tuple]) -> Counter:
    seen, outcome = set(), Counter()
    for row in rows:
        broken = broken_rules(row)
        missing = any(v is None for n, v in zip(NAMES, row) if n != "passenger_count")
        if broken:
            outcome["invalid", ", ".join(broken), None, row] += 1
        if missing:
            outcome["quarantined", None, "null", row] += 1
        if broken or missing:
            continue
        if None not in row and row in seen:
            outcome["quarantined", None, "duplicate", row] += 1
            continue
        seen.add(row)
        far = row[3] > 200 or (row[1] - row[0]).total_seconds() > 86_400
        if far:
            outcome["quarantined", None, "outlier", row] += 1
        else:
            outcome["valid", None, None, row] += 1
    return outcome


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_rows(spark, seed):
    rnd = random.Random(seed)
    rows = [random_row(rnd) for _ in range(600)]
    rows += [rnd.choice(rows) for _ in range(300)]
    want = expected(rows)
    quality = Classification(spark.createDataFrame(rows, CANONICAL))
    got = Counter(
        (r["class"], r.violation_reasons, r.quarantine_reason, tuple(r[n] for n in NAMES))
        for r in quality.outcomes().collect()
    )
    assert got == want
    by_class = Counter()
    reasons = Counter()
    for (label, _, reason, _), n in want.items():
        by_class[label] += n
        reasons[reason] += n
    counts = quality.counts().first()
    assert counts.total_rows == len(rows)
    assert counts.valid_rows == by_class["valid"] == quality.valid().count()
    assert counts.invalid_rows == by_class["invalid"] == quality.invalid().count()
    assert counts.quarantined_rows == by_class["quarantined"]
    assert (counts.null_rows, counts.duplicate_rows, counts.outlier_rows) == (
        reasons["null"],
        reasons["duplicate"],
        reasons["outlier"],
    )
    held = Counter(
        (r.quarantine_reason, tuple(r[n] for n in NAMES)) for r in quality.quarantined().collect()
    )
    assert held == Counter({(k[2], k[3]): n for k, n in want.items() if k[0] == "quarantined"})

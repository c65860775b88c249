"""First and last by a total order: hash aggregate, tied groups again."""
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.aggregates import first_last_total

SCHEMA = "k string, g int, lead long, a int, b string, v double"


def ends(spark, rows, **kwargs):
    df = spark.createDataFrame(rows, SCHEMA)
    out = first_last_total(df, ["k", "g"], "lead", ["a", "b"], {"first_v": "v", "first_b": "b"}, {"last_v": "v"},
                           [F.count(F.lit(1)).alias("n")], **kwargs)
    assert out.columns == ["k", "g", "first_v", "first_b", "last_v", "n"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


def twin(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[:2], []).append(r)
    out = []
    for key, group in groups.items():
        # Like a struct: null sorts first.
        group.sort(key=lambda r: (r[2], r[3] is not None, r[3] or 0, r[4] is not None, r[4] or ""))
        out.append((*key, group[0][5], group[0][4], group[-1][5], len(group)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("spread", [1, 3, 10 ** 12])
def test_random_orders(spark, spread):
    """spread 1: every row ties with every other; 10**12: none does."""
    rng = random.Random(spread)
    rows = []
    for n in range(2000):
        lead = rng.randrange(-spread, spread)
        rows.append((rng.choice(["x", "y", None]), rng.choice([1, 2, None, 3]), lead, rng.choice([None, 1, 2, n]), rng.choice([None, "p", str(n)]), float(n)))
    rows = list({(r[0], r[1], r[2], r[3], r[4]): r for r in rows}.values())  # a total order within each group
    assert ends(spark, rows) == twin(rows)


def test_only_some_groups_tie(spark):
    rows = [("x", g, n, n, "p", float(n)) for g in range(50) for n in range(20)]
    rows += [("x", 7, 0, -1, "p", -5.0), ("x", 9, 19, 99, "p", 99.0), ("x", 9, 10, 10, "q", 77.0)]
    got = ends(spark, rows)
    assert got == twin(rows) and ("x", 7, -5.0, "p", 19.0, 21) in got and ("x", 9, 0.0, "p", 99.0, 22) in got


def test_repeated_rows_and_empty_table(spark):
    assert ends(spark, [("x", 1, 5, 1, "p", 2.0)] * 4) == [("x", 1, 2.0, "p", 2.0, 4)]
    assert ends(spark, []) == []


def test_lead_out_of_range_fails(spark):
    for lead in (None, 1 << 46, -(1 << 46) - 1):
        with pytest.raises(Exception, match="lead missing or out of range"):
            ends(spark, [("x", 1, lead, 1, "p", 2.0)])
    assert ends(spark, [("x", 1, (1 << 46) - 1, 1, "p", 2.0), ("x", 1, -(1 << 46), 1, "p", 1.0)]) == [("x", 1, 1.0, "p", 2.0, 2)]

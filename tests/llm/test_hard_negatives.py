import math
import random

import pytest
from pyspark.sql import functions as F

from rallybook.llm import hard_negatives as module
from rallybook.llm.hard_negatives import hard_negatives, products

COLUMNS = "vec_id long, label int, embedding array<double>"


def by_hand(rows):
    """All pairs in plain Python integers."""
    fine = [r for r in rows if r[1] is not None and r[2] is not None and all(x is not None and math.isfinite(x) for x in r[2])]
    fine = [(i, label, [math.floor(256 * x) for x in v]) for i, label, v in fine]
    out = []
    for at, (anchor, label, v) in enumerate(fine):
        if anchor is None or anchor % 100:
            continue
        near = [(sum(a * b for a, b in zip(v, w)), i, other) for k, (i, other, w) in enumerate(fine) if k != at]
        near.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0))
        positives = [x for x in near if x[2] == label][:5]
        for score, positive, _ in positives:
            fits = [x for x in near if x[2] != label and 30 * score <= 100 * x[0] <= 90 * score][:10]
            out += [(anchor, positive, i + 1, x[1], score, x[0]) for i, x in enumerate(fits)]
    return sorted(out, key=str)


def run(spark, rows, parts=3, columns=COLUMNS, **more):
    table = spark.createDataFrame(rows, columns).repartition(parts)
    return sorted(map(tuple, hard_negatives(table.withColumns(more) if more else table, F.col("vec_id") % 100 == 0).collect()), key=str)


def vector(size=6):
    return [random.choice([-1.0, -0.5, 0.0, 0.25, 0.5, 1.0, 1.5]) for _ in range(size)]


def test_equals_plain_python(spark):
    """With many ties, repeated rows, odd ids, and vectors of other lengths."""
    random.seed(11)
    rows = [(i, random.randrange(3), vector()) for i in range(0, 800, 2)]
    rows += [(r[0] + 1, 0, rows[0][2]) for r in rows[:60]]
    rows += [(None, 1, vector()), (None, 0, vector()), (3000, None, vector()), (3001, 1, None), (3100, 1, [1.0, None]),
             (3200, 1, [float("nan")] * 6), (3300, 1, [float("inf")] * 6), (3400, 2, []), (3500, 1, [0.5, 1.0]), (-100, 2, vector(9))]
    rows += [rows[0], rows[0], rows[50]]
    assert run(spark, rows) == by_hand(rows)


def test_a_window_of_score_zero(spark):
    """Its negatives score 0 too and may have smaller ids than the positive."""
    rows = [(100, 1, [1.0, 0.0]), (50, 1, [0.0, 1.0]), (7, 2, [0.0, 1.0]), (90, 2, [0.0, -1.0]), (8, 2, [-1.0, 0.0])]
    assert run(spark, rows) == [(100, 50, 1, 7, 0, 0), (100, 50, 2, 90, 0, 0)] == by_hand(rows)


def test_clashing_columns_and_one_hot_label(spark):
    random.seed(5)
    rows = [(i, 1 if i % 3 else i % 7, vector()) for i in range(900)]
    clash = {c: F.lit(1) for c in ("row", "anchor", "windows", "score", "id", "block", "is_anchor", "vector")}
    assert run(spark, rows, parts=9, **clash) == by_hand(rows)


@pytest.mark.parametrize("rows", [[], [(100, 1, [1.0])], [(100, 1, [1.0]), (1, 2, [1.0])], [(5, 1, [1.0]), (6, 1, [1.0])]])
def test_few_rows(spark, rows):
    assert run(spark, rows) == []


@pytest.mark.parametrize("size", [1, 1000, 1 << 20, 1 << 26])
def test_large_components_are_exact(size):
    import numpy as np

    random.seed(size)
    a = np.array([[float(random.randrange(-size, size + 1)) for _ in range(5)] for _ in range(4)])
    b = np.array([[float(random.randrange(-size, size + 1)) for _ in range(5)] for _ in range(3)])
    exact = [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a]
    assert products(a, b).tolist() == exact


def test_a_score_beyond_64_bits_fails():
    import numpy as np

    with pytest.raises(OverflowError):
        products(np.array([[2.0**40]]), np.array([[2.0**40]]))


def test_long_vectors(spark):
    random.seed(2)
    rows = [(i, i % 2, [random.uniform(-1, 1) for _ in range(20_000)]) for i in (0, 1, 2, 3, 4)]
    assert run(spark, rows) == by_hand(rows)


def test_blocks_split_over_slots(spark, monkeypatch):
    monkeypatch.setattr(module, "BLOCKS_PER_SLOT", 1)
    random.seed(8)
    rows = [(i, random.randrange(2), vector()) for i in range(300)]
    assert run(spark, rows, parts=20) == by_hand(rows)

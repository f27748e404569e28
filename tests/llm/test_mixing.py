from fractions import Fraction

import pytest

from rallybook.llm.mixing import mixed, targets


def water_fill(sizes, weights, budget, cap):
    """Targets by repeated clamping, in exact arithmetic."""
    fixed, free = {}, set(sizes)
    while True:
        left = budget - sum(fixed.values())
        weight = sum(weights[s] for s in free)
        share = {s: Fraction(left * weights[s], weight) for s in free}
        over = {s for s in free if share[s] > cap * sizes[s]}
        if not over:
            return {**fixed, **share}
        fixed |= {s: Fraction(cap * sizes[s]) for s in over}
        free -= over


@pytest.mark.parametrize("budget", [None, 10, 5000, 100_000])
def test_targets_equal_repeated_clamping(spark, budget):
    sizes = {"a": 5, "b": 1000, "c": 7, "d": 300, "e": 0, "f": 20, None: 50}
    weights = dict(zip(sizes, [1, 2, 3, 1, 2, 3, 1]))
    rows = [(s, n, weights[s]) for s, n in sizes.items()]
    got = targets(spark.createDataFrame(rows, "source string, source_size long, weight int"), budget).collect()
    total = sum(sizes.values()) if budget is None else budget
    if total >= 3 * sum(sizes.values()):
        expected = {s: 3 * n for s, n in sizes.items()}
    else:
        expected = water_fill(sizes, weights, total, 3)
    assert {r.source: r.target for r in got} == pytest.approx({s: float(t) for s, t in expected.items()})


def test_mix_meets_targets_and_reruns_agree(spark):
    rows = [(i, "word " * (i % 9), "hot" if i % 3 == 0 else f"s{i % 4}") for i in range(600)]
    rows += [(601, None, "hot"), (602, "", "nothing"), (603, "  one", None), (None, "two words", None), (5, "a b", "s1"), (5, "a b", "s1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    first = mixed(docs).collect()
    again = mixed(docs.repartition(7)).collect()
    assert sorted(map(str, first)) == sorted(map(str, again)) and len(first) == len(rows)
    taken, target = {}, {}
    for r in first:
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.whole * r.size + r.part
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in target)
    assert {r.doc_id: r.size for r in first}[603] == 2
    assert any(0 < r.part < r.size for r in first)


def test_empty_table(spark):
    assert mixed(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0

import random
import re

import pytest

from rallybook.llm.decontaminate import contamination


def words(text):
    lowered = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)


def brute_force(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(len(w), 10)
        if n:
            for i in range(len(w) - n + 1):
                windows.setdefault(tuple(w[i : i + n]), set()).update([] if item is None else [str(item)])
    out = []
    for d, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        out.append((d, len(w), len(hit), sorted(found), bool(hit)))
    return sorted(out, key=str)


def found(spark, docs, items):
    rows = contamination(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
    )
    return sorted((tuple(r) for r in rows.collect()), key=str)


@pytest.mark.parametrize("short", [False, True])
def test_windows_of_any_length(spark, short):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(60)] + ["Straße", "ÉCOLE", "école", "12"]

    def text(n):
        return " ".join(rng.choice(vocabulary) + rng.choice(["", ".", ",", "-"]) for _ in range(n))

    items = [(i, text(rng.randrange(10, 40))) for i in range(20)] + [(50, None), (51, ""), (52, "..."), (None, text(15))]
    items += [(3, text(12)), (3, text(12))]
    if short:
        items += [(60 + i, text(i)) for i in range(1, 10)]
    docs = [(i, text(rng.randrange(0, 120))) for i in range(40)]
    for i, (_, t) in enumerate(items):
        parts = (t or "").split()
        cut = parts[rng.randrange(3) : len(parts) - rng.randrange(3)]
        docs.append((100 + i, " ".join([*text(20).split(), *cut, *text(5).split()]).upper()))
    docs += [(None, items[0][1]), (200, None), (201, ""), (202, items[1][1]), (202, items[1][1]), (203, (items[2][1] + " ") * 50)]
    assert found(spark, docs, items) == brute_force(docs, items)


def test_a_text_that_holds_a_whole_long_item(spark):
    """With as many marks as the item has windows, and prints that come many times over."""
    rng = random.Random(7)
    long = " ".join(f"w{rng.randrange(3000)}" for _ in range(6000)) + " same" * 400
    items = [(1, long), (None, " ".join(f"v{rng.randrange(50)}" for _ in range(300))), (2, "ten " * 10)]
    docs = [(1, long), (2, "begin " + long[300:20_000] + " end"), (3, items[1][1]), (4, "same " * 30), (5, "ten " * 12)]
    assert found(spark, docs, items) == brute_force(docs, items)


def test_clashing_columns(spark):
    from pyspark.sql import functions as F

    clash = {c: F.lit(1) for c in ("key", "mark", "marks", "item", "m", "h", "prints", "own", "near", "window", "words", "n_words")}
    item = "one two three four five six seven eight nine ten eleven"
    docs = spark.createDataFrame([(1, f"a {item} b"), (2, "clean")], "doc_id long, text string").withColumns(clash)
    items = spark.createDataFrame([(7, item)], "item_id long, text string").withColumns(clash)
    assert sorted(map(tuple, contamination(docs, items).collect())) == [(1, 13, 11, ["7"], True), (2, 1, 0, [], False)]


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a b c")]) == []
    assert found(spark, [(1, "a b c")], []) == [(1, 3, 0, [], False)]

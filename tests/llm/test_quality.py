"""Operators 9 and 10."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from rallybook.llm import quality_rules as Q, weak_quality as W


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_statistics(text):
    w, text = words_of(text), text or ""
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = Counter(grams)
    repeated = {j for i, g in enumerate(grams) if often[g] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if words_of(x)]
    return (
        len(w),
        sum(map(len, w)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(repeated),
    )


def corpus(rng):
    vocabulary = ["the", "of", "straße", "naïve", "word", "日本", "a", "<b>", "x|y", "end."]
    rows = []
    for i in range(260):
        sentence = lambda n: " ".join(rng.choice(vocabulary) + str(rng.randrange(60)) for _ in range(n))
        text = "\n".join(sentence(rng.randrange(3, 15)) for _ in range(rng.randrange(1, 25)))
        if i % 37 == 0:
            text = "#$%& " * 20 + text
        rows.append((i, text, rng.choice(["en", "de"]), rng.choice(["hot", "hot", "small", None])))
    odd = ["", None, " \n\t", "one", "a b c a b c", "a a a a a", "same\nsame\n \nsame", "w " * 3000, "x" * 5000]
    rows += [(1000 + i, t, None if i % 2 else "en", "hot") for i, t in enumerate(odd)]
    return rows + [(None, rows[3][1], "en", "hot"), rows[5], rows[5]]


COLUMNS = "doc_id long, text string, lang string, source string"


def test_statistics_equal_plain_counts(spark):
    rows = corpus(random.Random(3))
    got = Q.statistics(spark.createDataFrame(rows, COLUMNS).select("doc_id", "text")).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    found = Counter((r.doc_id, *[r[n] for n in names]) for r in got)
    assert found == Counter((d, *plain_statistics(t)) for d, t, _, _ in rows)


def brute_force_distances(rows):
    """The concentration steps in numpy, on the same whole units and bins."""
    vectors = []
    for r in rows:
        n = max(r.n_words, 1)
        values = {
            "words": np.log1p(r.n_words),
            "length": min(r.word_chars / n, Q.LONGEST),
            "symbols": np.sqrt(min(r.n_symbols / n, 4.0)),
            "lines": r.n_dup_lines / (r.n_dup_lines + 10),
            "repeats": np.sqrt(r.n_repeat_words / n),
        }
        vectors.append([np.floor(values[d] / Q.FLOORS[d] * Q.UNIT + 0.5) for d in Q.DIMENSIONS])
    vectors = np.array(vectors)
    groups = defaultdict(list)
    good = defaultdict(list)
    for i, r in enumerate(rows):
        groups[r.lang, r.source].append(i)
        if not r.base_failed:
            for key in ((0, r.lang, r.source), (1, r.lang), (2,)):
                good[key].append(i)
    out = [None] * len(rows)
    for (lang, source), members in groups.items():
        own = next((good[k] for k in ((0, lang, source), (1, lang)) if len(good[k]) >= Q.FEWEST), good[2,])
        if not own:
            continue
        x = vectors[own]
        v = np.floor(x / (Q.UNIT // 16))
        middle = (len(x) + 1) // 2 - 1
        m = np.sort(v, axis=0)[middle]
        a = np.sort(np.abs(v - m), axis=0)[middle]
        mean, cov = (m + 0.5) / 16, np.diag((a / 16 * 1.4826) ** 2 + 1)
        for _ in range(Q.STEPS):
            z = x / Q.UNIT - mean
            d = np.einsum("ij,jk,ik->i", z, np.linalg.inv(cov), z)
            b = np.floor(np.log2(d + 2.0**-10) * 64)
            limit = np.sort(b)[int(np.ceil(len(b) * Q.COVERAGE)) - 1]
            inner = x[b <= limit] / Q.UNIT
            mean = inner.mean(axis=0)
            cov = np.cov(inner.T, bias=True) * Q.CONSISTENCY + np.eye(len(mean))
        for i in members:
            z = vectors[i] / Q.UNIT - mean
            out[i] = z @ np.linalg.inv(cov) @ z
    return out


def many_sizes():
    """Sources and languages of many sizes, and texts with one word of a million characters."""
    rng = random.Random(5)
    rows = corpus(random.Random(4))
    for k in range(15):
        for i in range(3 + k):
            text = " ".join(rng.choice("abcdefgh") + str(rng.randrange(80)) for _ in range(rng.randrange(30, 150)))
            rows.append((5000 + 100 * k + i, text, "fr" if k % 2 else f"rare{k}", f"tiny{k}"))
    plain = " ".join(f"word{i}" for i in range(58))
    return rows + [(9000, plain + " " + "x" * 17_000_000, "xx", "alone"), (9001, plain + " " + "x" * 1_000_000, "en", "hot")]


@pytest.mark.parametrize("rows", [corpus(random.Random(3)), many_sizes(), corpus(random.Random(6))[:9]])
def test_distances_equal_numpy(spark, rows):
    few, rows = len(rows) < 50, Q.judged(spark.createDataFrame(rows, COLUMNS)).collect()
    for r, d in zip(rows, brute_force_distances(rows)):
        assert (r.distance is None) == (d is None)
        if d is not None:
            assert r.distance == pytest.approx(d, rel=1e-6, abs=1e-6)
            assert r.kept == (not r.base_failed and r.distance <= Q.CUTOFF)
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == failed and (not failed or not r.kept)
    assert few or any(not r.kept and not r.base_failed for r in rows)


def test_an_outlier_is_found_in_a_group_of_any_size(spark):
    rng = random.Random(2)
    plain = [(i, " ".join(f"w{rng.randrange(5000)}" for _ in range(400 + 5 * i)), "en", "small") for i in range(10)]
    odd = (99, "".join(f"w{i} {'#$' * 3} " for i in range(459)), "en", "small")
    clash = {c: Q.F.lit("x") for c in ("level", "e", "members", "words", "bin", "limit", "_lang", "distance")}
    docs = spark.createDataFrame([*plain, odd], COLUMNS)
    assert {r.doc_id for r in Q.judged(docs.withColumns(clash)).collect() if not r.kept} == {99}
    failing = spark.createDataFrame([(1, "too short", "en", "a"), (2, None, None, None)], COLUMNS)
    assert [(r.distance, r.kept) for r in Q.judged(failing).collect()] == [(None, False)] * 2


def test_rules_on_an_empty_table(spark):
    assert Q.judged(spark.createDataFrame([], COLUMNS)).count() == 0


def test_posteriors_find_the_accuracies():
    rng = np.random.default_rng(1)
    truth = rng.random(20000) < 0.8
    accuracy = np.array([0.95, 0.9, 0.85, 0.8])
    said = np.where(rng.random((20000, 4)) < accuracy, truth[:, None], ~truth[:, None]).astype(int)
    said[rng.random(said.shape) < 0.2] = W.NONE
    patterns, of, counts = np.unique(said, axis=0, return_inverse=True, return_counts=True)
    good = W.posteriors(patterns, counts.astype(float))[of.ravel()]
    assert ((good > 0.5) == truth).mean() > 0.93
    order = np.argsort(good)
    assert truth[order[:2000]].mean() < 0.1 and truth[order[-2000:]].mean() > 0.95


def test_posteriors_equal_plain_python():
    """One labeller table and prior after another, pattern by pattern."""
    import math

    rng = random.Random(1)
    patterns = np.array([[rng.choice([W.BAD, W.GOOD, W.NONE]) for _ in range(4)] for _ in range(50)])
    patterns = np.unique(patterns, axis=0)
    counts = [rng.randrange(1, 40) for _ in patterns]
    good = [0.1 if W.BAD in p else 0.9 for p in patterns.tolist()]
    for _ in range(W.ROUNDS):
        prior, table = [], []
        for weight in ([1 - g for g in good], good):
            weight = [w * c for w, c in zip(weight, counts)]
            prior.append((sum(weight) + 1) / (sum(counts) + 2))
            seen = [{v: 1 + sum(w for w, p in zip(weight, patterns) if p[j] == v) for v in (W.BAD, W.GOOD, W.NONE)} for j in range(4)]
            table.append([{v: n / sum(s.values()) for v, n in s.items()} for s in seen])
        after = []
        for p in patterns:
            bad_log, good_log = (math.log(prior[c]) + sum(math.log(table[c][j][v]) for j, v in enumerate(p)) for c in (0, 1))
            after.append(1 / (1 + math.exp(max(-50, min(50, bad_log - good_log)))))
        done = max(abs(a - b) for a, b in zip(after, good)) < 1e-9
        good = after
        if done:
            break
    assert W.posteriors(patterns, np.array(counts, float)) == pytest.approx(good, abs=1e-9)


def test_a_share_of_any_number_of_rows(spark):
    from rallybook.llm.columns import sampled_by, unused

    hashes = spark.range(100_000).withColumn("h", Q.F.xxhash64("id"))
    for rows, total in ((100_000, 100_000), (50_000, 100_000), (5, 3), (10**10, 10**12), (10_000, 10**11)):
        found = hashes.where(sampled_by(Q.F.col("h"), rows, total)).count()
        assert found == pytest.approx(100_000 * min(1, rows / total), abs=500)
    least = spark.createDataFrame([(0,), (1,), (-1,)], "h long")
    # Shares far below one in 10^10 still choose some hashes, and no share leaves any out of all.
    assert least.where(sampled_by(Q.F.col("h"), 10_000, 10**16)).count() == 2
    assert least.where(sampled_by(Q.F.col("h"), 7, 7)).count() == 3
    assert unused("_url", ["_URL", "_url_"]) == "_url__"


def test_nothing_to_fit_on_fails(spark):
    with pytest.raises(ValueError, match="no text was chosen"):
        W.classified(spark.createDataFrame([(1, "some text"), (2, "other")], "doc_id long, text string"), train_rows=0).collect()


def test_scorer_against_labels_it_never_saw(spark):
    sf = "/root/testdata/sf0.01"
    rows = W.classified(spark.read.parquet(f"{sf}/documents.parquet"))
    rows = rows.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.3


def test_scorer_on_odd_rows(spark):
    rows = corpus(random.Random(8))
    docs = spark.createDataFrame(rows, COLUMNS).withColumn("score", Q.F.lit("clash"))
    got = W.classified(docs).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    assert all(0 <= r.score <= 1 and 0 <= r.posterior <= 1 for r in got)
    assert W.classified(docs.limit(0)).count() == 0

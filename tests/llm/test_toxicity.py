import random

import numpy as np
import pytest

from rallybook.llm import toxicity as T


def rows_with_pairs(rng, n):
    """Two words are toxic in some pairs only; neither decides alone."""
    rows, labels = [], []
    for _ in range(n):
        words = [f"plain{rng.randrange(3000)}" for _ in range(rng.randrange(20, 100))]
        pair = rng.choice([("aaa", "xxx"), ("aaa", "yyy"), ("bbb", "xxx"), ("bbb", "yyy"), ()])
        rows.append(" ".join(rng.sample([*words, *pair], len(words) + len(pair))))
        labels.append(int(pair in (("aaa", "xxx"), ("bbb", "yyy"))))
    return rows, labels


def frame(spark, rows, columns):
    return spark.createDataFrame(rows, columns)


def test_pairs_of_terms_are_learned(spark):
    rng = random.Random(4)
    texts, labels = rows_with_pairs(rng, 3000)
    docs = frame(spark, list(enumerate(texts)), "doc_id long, text string")
    model = T.trained(docs.where("doc_id < 2400"), frame(spark, list(enumerate(labels)), "doc_id long, toxic int"))
    got = {r.doc_id: r.score for r in T.scored(docs.where("doc_id >= 2400"), model).collect()}
    right = np.mean([(got[i] >= 0.5) == labels[i] for i in got])
    assert right > max(np.mean(labels), 1 - np.mean(labels)) + 0.1


def test_held_out_accuracy_on_the_given_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = T.toxicity(docs, labels).where("held_out").join(labels, "doc_id").collect()
    toxic = [r.predicted for r in rows if r.toxic == 1]
    clean = [r.predicted for r in rows if r.toxic == 0]
    assert np.mean(toxic) > 0.6 and np.mean(clean) < 0.005


def test_terms_equal_a_plain_count():
    import pyarrow as pa

    texts = ["Abcdef abc ABCDEF", None, "", "abcdeg", "é" * 10]
    found, of = T.terms(T.flat_texts(pa.array(texts)))
    # Words, beginnings of four bytes and of five; the first and fourth text share beginnings.
    assert np.diff(of).tolist() == [4, 0, 0, 3, 3]
    assert len(set(found[of[0] : of[1]]) & set(found[of[3] : of[4]])) == 2


@pytest.mark.parametrize("labels", [[], [(1, None)], [(None, 1)], [(1, 1), (1, 0), (2, 0)]])
def test_odd_rows_and_labels(spark, labels):
    docs = [(1, "some text", 0.5), (2, None, 0.5), (2, None, 0.5), (None, "", 0.5), (3, "word " * 100_000, 0.5)]
    rows = T.toxicity(
        frame(spark, docs, "doc_id long, text string, score double"), frame(spark, labels, "doc_id long, toxic int")
    ).collect()
    assert len(rows) == len(docs) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == int(r.score >= T.THRESHOLD) for r in rows)


def test_empty_table(spark):
    docs = frame(spark, [], "doc_id long, text string")
    assert T.toxicity(docs, frame(spark, [(1, 1)], "doc_id long, toxic int")).count() == 0

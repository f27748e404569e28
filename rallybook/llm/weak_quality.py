"""Operator 9: a quality classifier from weak labels.

Heuristic labellers vote good, bad or nothing on every document. Only how often each pattern of votes
occurs is needed to estimate, by expectation-maximisation over all documents, how often each labeller
says what about good and bad documents; there are at most 3^8 patterns, counted by a group-by.
Every pattern then has a posterior probability of being good. These are the labels of a
hashed linear scorer, fitted on at most `TRAIN_ROWS` documents and applied to all. No given labels are used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rallybook.llm.columns import sampled_by
from rallybook.llm.quality_rules import statistics
from rallybook.llm.text import LOWER, U, Texts, flat_texts, hash_spans, mix, slices, split_words
from rallybook.sources.scratch import stored, work_folder

BITS = 18
TRAIN_ROWS = 10_000
EPOCHS = 5
ROUNDS = 100
THRESHOLD = 0.5
BATCH_BYTES = 4 << 20
GOOD, BAD, NONE = 1, 0, 2


def vote(bad: Column, good: Column | None = None) -> Column:
    first = F.when(bad, BAD)
    return (first if good is None else first.when(good, GOOD)).otherwise(NONE)


def labellers() -> dict[str, Column]:
    """The votes, from the statistics of a document."""
    n = F.greatest("n_words", F.lit(1))
    symbols, length, repeats = F.col("n_symbols") / n, F.col("word_chars") / n, F.col("n_repeat_words") / n
    return {
        "words": vote(F.col("n_words") < 20, F.col("n_words") >= 60),
        "symbols": vote(symbols > 0.3, symbols < 0.03),
        "lines": vote(F.col("n_dup_lines") >= 3, F.col("n_dup_lines") == 0),
        "repeats": vote(repeats > 0.3, repeats < 0.1),
        "length": vote((length > 9) | (length < 2.5), (length > 3) & (length < 7)),
        "shouting": vote(F.col("n_shouts") / n > 0.1, F.col("n_shouts") / n < 0.02),
        "bars": vote(F.col("n_bars") / n > 0.1, F.col("n_bars") == 0),
        "stops": vote(F.col("n_stops") / n < 0.02, F.col("n_stops") / n > 0.04),
    }


def votes(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    counted = docs.withColumns(
        {
            "n_shouts": F.regexp_count(text, F.lit("!!")),
            "n_bars": F.regexp_count(text, F.lit(" [|] ")),
            "n_stops": F.regexp_count(text, F.lit(r"[.!?](\s|$)")),
        }
    )
    return statistics(counted).select("doc_id", *[v.alias(f"vote_{k}") for k, v in labellers().items()])


def posteriors(patterns: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The probability of good for each pattern of votes, by expectation-maximisation. Labellers look for
    different faults, so to begin with a document is bad if any of them says so."""
    good = np.where((patterns == BAD).any(axis=1), 0.1, 0.9)
    said = np.stack([patterns == v for v in (BAD, GOOD, NONE)], axis=2).astype(float)
    for _ in range(ROUNDS):
        weight = np.stack([(1 - good) * counts, good * counts])
        # Smoothed as if each vote had been seen once more for either class.
        table = np.einsum("cp,pjv->cjv", weight, said) + 1.0
        table /= table.sum(axis=2, keepdims=True)
        prior = (weight.sum(axis=1) + 1.0) / (counts.sum() + 2.0)
        log = np.log(prior)[:, None] + np.einsum("cjv,pjv->cp", np.log(table), said)
        after = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
        if np.abs(after - good).max(initial=0) < 1e-9:
            return after
        good = after
    return good


def labelled(docs: DataFrame, folder: str) -> DataFrame:
    """`doc_id`, the votes and `posterior` of every row."""
    rows = stored(votes(docs), f"{folder}/votes")
    names = rows.columns[1:]
    counts = rows.groupBy(*names).agg(F.count("*").alias("c")).orderBy(*names).collect()
    spark = docs.sparkSession
    table = np.array([[r[n] for n in names] for r in counts], int).reshape(-1, len(names))
    good = posteriors(table, np.array([r.c for r in counts], float))
    known = [(*map(int, p), float(g)) for p, g in zip(table, good)]
    schema = ", ".join(f"{n} int" for n in names) + ", posterior double"
    return rows.join(F.broadcast(spark.createDataFrame(known, schema)), names)


def terms(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed terms of every word, its shape included: whole, first three and last three bytes. Text of
    each, and the terms themselves."""
    buf = LOWER[texts.buf]
    words = split_words(Texts(buf, texts.start))
    doc = np.repeat(np.arange(len(texts.lengths)), np.diff(words.of))
    short = np.minimum(words.end - words.start, 3)
    hashes = [
        hash_spans(buf, words.start, words.end),
        mix(hash_spans(buf, words.start, words.start + short) + U(1)),
        mix(hash_spans(buf, words.end - short, words.end) + U(2)),
    ]
    return np.tile(doc, 3), np.concatenate([(h >> U(64 - BITS)).astype(np.int64) for h in hashes]), words.of


def fit(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Weights of a logistic model of the mean term; the last is the bias."""
    rng, w, g2 = np.random.default_rng(9), np.zeros((1 << BITS) + 1), np.full((1 << BITS) + 1, 1e-6)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            x, count = np.unique(rows[i], return_counts=True)
            value = count / max(len(rows[i]), 1)
            error = 1 / (1 + np.exp(-np.clip(w[-1] + w[x] @ value, -30, 30))) - labels[i]
            slope = error * value
            g2[x] += slope * slope
            w[x] -= 0.5 * slope / np.sqrt(g2[x])
            g2[-1] += error * error
            w[-1] -= 0.1 * error / np.sqrt(g2[-1])
    return w


def classified(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """`doc_id`, `posterior` of the labellers, `score` of the linear model (0 to 1, higher: better) and
    `kept`, a score of 0.5 or more.

    Null and empty texts have no terms and score by the bias alone. Repeated rows and null ids get an
    answer each; an empty table gives an empty result. Other columns are not looked at.
    """
    spark = docs.sparkSession
    folder = work_folder(spark)
    docs = docs.select("doc_id", "text").withColumn("_row", F.md5(F.coalesce("text", F.lit(""))))
    known = stored(labelled(docs.select(F.struct("doc_id", "_row").alias("doc_id"), "text"), folder), f"{folder}/labelled")
    known = known.select("doc_id.doc_id", "doc_id._row", "posterior")
    # Copies of a text have the same votes, so one posterior per text.
    of_text = known.groupBy("_row").agg(F.max("posterior").alias("posterior"), F.count("*").alias("copies"))
    total = of_text.count()
    chosen = sampled_by(F.xxhash64(F.lit("fit"), "_row"), train_rows, total)
    sample = docs.select("_row", "text").join(of_text.where(chosen), "_row").dropDuplicates(["_row"])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            doc, found, _ = terms(flat_texts(batch.column("text")))
            order = np.argsort(doc, kind="stable")
            of = np.searchsorted(doc[order], np.arange(batch.num_rows + 1))
            lists = pa.ListArray.from_arrays(pa.array(of, pa.int32()), pa.array(found[order].astype(np.int32)))
            yield pa.record_batch({"row": batch.column("_row"), "label": batch.column("posterior"), "terms": lists})

    def learn(table: pa.Table) -> pa.Table:
        table = table.sort_by("row")
        weights = fit([x.values.to_numpy() for x in table["terms"]], table["label"].to_numpy())
        return pa.table({"weights": pa.array([weights.astype(np.float32).tobytes()], pa.binary())})

    features = sample.mapInArrow(extract, "row string, label double, terms array<int>").withColumn("model", F.lit(0))
    fitted = features.groupBy("model").applyInArrow(learn, "weights binary").first()
    if fitted is None and total:
        raise ValueError("no text was chosen to fit on")
    weights = np.frombuffer(bytes(fitted[0]), np.float32) if fitted else np.zeros((1 << BITS) + 1, np.float32)
    held = spark.sparkContext.broadcast(weights)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            doc, found, of = terms(flat_texts(batch.column("text")))
            total = np.bincount(doc, held.value[found], batch.num_rows)
            mean = total / np.maximum(3 * np.diff(of), 1)
            rate = 1 / (1 + np.exp(-np.clip(held.value[-1] + mean, -30, 30)))
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "_row": batch.column("_row"), "score": pa.array(rate)})

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.mapInArrow(score, f"doc_id {kind}, _row string, score double")
    out = scored.join(of_text.select("_row", "posterior"), "_row", "left")
    return out.select("doc_id", "posterior", "score", (F.col("score") >= THRESHOLD).alias("kept"))

"""Operator 5: toxicity, by a factorization machine over hashed terms.

Terms are the distinct lower-cased words of a text and their beginnings of four and five bytes, so
inflected and compounded forms share something. A term adds its own weight; besides, every pair
of terms adds the product of their factors over the root of the number of terms, so that an insult beside the mention of a group can weigh
more than both alone. Weights follow the FTRL-proximal rule with an L1 penalty, which
leaves nearly all words at zero, and factors AdaGrad with shrinkage.

The model is fitted on at most `TRAIN_ROWS` labelled rows, chosen by a hash, whole texts, in one
task; scoring is a map over all documents with the model broadcast. Its size is fixed by `BITS`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rallybook.llm.columns import sampled_by
from rallybook.llm.text import LOWER, U, Texts, flat_texts, hash_spans, mix, slices, split_words

BITS = 18
FACTORS = 4
TRAIN_ROWS = 16_000
EPOCHS = 4
THRESHOLD = 0.3
BATCH_BYTES = 4 << 20
LEAST_SEEN = 4

# Words end at everything in ASCII but letters and digits.
BREAKS = np.ones(256, bool)
BREAKS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def terms(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashed terms of each text, end to end, and where each text's begin."""
    buf = LOWER[texts.buf]
    words = split_words(Texts(buf, texts.start), BREAKS)
    doc = np.repeat(np.arange(len(texts.lengths), dtype=np.int64), np.diff(words.of))
    h = hash_spans(buf, words.start, words.end)
    _, first = np.unique((doc.astype(U) << U(40)) | (h >> U(24)), return_index=True)
    start, end, doc, h = words.start[first], words.end[first], doc[first], h[first]
    found = [(doc << BITS) | (h >> U(64 - BITS)).astype(np.int64)]
    for length in (4, 5):
        long = end - start > length
        begin = mix(hash_spans(buf, start[long], start[long] + length) + U(length))
        found.append((doc[long] << BITS) | (begin >> U(64 - BITS)).astype(np.int64))
    every = np.unique(np.concatenate(found))
    of = np.searchsorted(every >> BITS, np.arange(len(texts.lengths) + 1))
    return every & ((1 << BITS) - 1), of


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(columns: list[np.ndarray], labels: np.ndarray) -> dict[str, np.ndarray]:
    """Bias, weights and factors from the terms and the label of each row."""
    size = 1 << BITS
    seen = np.zeros(size, np.int32)
    for x in columns:
        seen[x] += 1
    columns = [x[seen[x] >= LEAST_SEEN] for x in columns]
    rng = np.random.default_rng(5)
    z, n = np.zeros(size), np.zeros(size)
    v = np.where(seen[:, None] >= LEAST_SEEN, rng.normal(0, 0.05, (size, FACTORS)), 0.0)
    g2 = np.full(size, 1e-2)
    alpha, beta, l1, l2 = 0.2, 1.0, 4.0, 0.1
    share = labels.mean() if len(labels) else 0.0
    bias = float(np.log((share + 1e-3) / (1 - share + 1e-3)))
    rate, shrink = 0.02, 1e-4

    def weights(x):
        w = -(z[x] - np.sign(z[x]) * l1) / ((beta + np.sqrt(n[x])) / alpha + l2)
        return np.where(np.abs(z[x]) <= l1, 0.0, w)

    for _ in range(EPOCHS):
        for row in rng.permutation(len(columns)):
            x, y = columns[row], labels[row]
            scale = max(len(x), 1) ** -0.25
            w, f = weights(x), v[x] * scale
            total = f.sum(axis=0)
            p = sigmoid(bias + w.sum() + 0.5 * (total @ total - (f * f).sum()))
            error = p - y
            bias -= 0.01 * error
            sigma = (np.sqrt(n[x] + error * error) - np.sqrt(n[x])) / alpha
            z[x] += error - sigma * w
            n[x] += error * error
            slope = error * (total - f) * scale + shrink * v[x]
            g2[x] += (slope * slope).mean(axis=1)
            v[x] -= rate * slope / np.sqrt(g2[x])[:, None]
    return {"bias": np.array([bias]), "w": weights(np.arange(size)).astype(np.float32), "v": v.astype(np.float32)}


def trained(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> dict[str, np.ndarray] | None:
    """A model from the labelled documents, at most about `rows` of them; None without labels.

    `labels` has doc_id and `toxic`; null labels are left out, and of several for a doc_id the
    largest counts.
    """
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    count = known.count()
    if not count:
        return None
    known = known.where(sampled_by(F.xxhash64(F.lit("fit"), "doc_id"), rows, count))
    sample = docs.select("doc_id", "text").join(known, "doc_id").withColumn("hash", F.xxhash64("text"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            found, of = terms(flat_texts(batch.column("text")))
            lists = pa.ListArray.from_arrays(pa.array(of, pa.int32()), pa.array(found.astype(np.int32)))
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "hash": batch.column("hash"), "toxic": batch.column("toxic").cast(pa.int32()), "terms": lists})

    def learn(table: pa.Table) -> pa.Table:
        # Rows that share an id are in one order too, whatever task they come from.
        table = table.sort_by([("doc_id", "ascending"), ("hash", "ascending")])
        model = fit([x.values.to_numpy() for x in table["terms"]], table["toxic"].to_numpy().astype(float))
        return pa.table({"name": list(model), "data": pa.array([m.tobytes() for m in model.values()], pa.binary())})

    features = sample.mapInArrow(extract, "doc_id long, hash long, toxic int, terms array<int>").withColumn("model", F.lit(0))
    fitted = features.groupBy("model").applyInArrow(learn, "name string, data binary").collect()
    if not fitted:
        return None
    data = {r.name: bytes(r.data) for r in fitted}
    return {
        "bias": np.frombuffer(data["bias"]),
        "w": np.frombuffer(data["w"], np.float32),
        "v": np.frombuffer(data["v"], np.float32).reshape(-1, FACTORS),
    }


def score(texts: Texts, model: dict[str, np.ndarray]) -> np.ndarray:
    found, of = terms(texts)
    count = np.diff(of)
    doc = np.repeat(np.arange(len(count)), count)
    linear = np.bincount(doc, model["w"][found], len(count))
    used = np.flatnonzero(model["v"][found, 0])
    doc, found = doc[used], found[used]
    width = np.maximum(np.bincount(doc, minlength=len(count)), 1)
    pairs = np.zeros(len(count))
    for f in range(FACTORS):
        v = model["v"][found, f].astype(float)
        pairs += np.bincount(doc, v, len(count)) ** 2 - np.bincount(doc, v * v, len(count))
    return sigmoid(model["bias"][0] + linear + 0.5 * pairs / np.sqrt(width))


def scored(docs: DataFrame, model: dict[str, np.ndarray] | None) -> DataFrame:
    """All rows and columns of `docs` with `score`, from 0 to 1; an earlier column of that name is
    replaced.

    Null and empty texts score what the bias alone gives. Without a model every score is 0. Ties
    and repeated rows score alike; an empty table stays empty.
    """
    docs = docs.drop("score")
    if model is None:
        return docs.withColumn("score", F.lit(0.0))
    held = docs.sparkSession.sparkContext.broadcast(model)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            values = score(flat_texts(batch.column("text")), held.value)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(values)], names=[*batch.schema.names, "score"]
            )

    return docs.mapInArrow(rate, docs.withColumn("score", F.lit(0.0).cast("double")).schema)


def held_out():
    """Rows whose labels are kept for testing."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`scored` by a model from the rows of `labels` that are not held out, with `held_out` and
    `predicted`."""
    rows = scored(docs, trained(docs, labels.where(~held_out())))
    return rows.withColumns({"held_out": held_out(), "predicted": (F.col("score") >= THRESHOLD).cast("int")})

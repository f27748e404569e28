"""Operator 12: hard negatives by a secondary sort.

Scores of (anchor, row) pairs are keyed by anchor, falling score and id, dealt by anchor and sorted
within partitions by Spark; a streaming iterator then reads each anchor's pairs in that order, opens
a window for each of its first positives and hands negatives to the windows that are open. It
holds a handful of windows and never the rows of an anchor.

Not all pairs are shuffled. Anchors meet the other rows block by block; of a block only the first
positives of each anchor can count, and, once the windows are known, of its negatives only the
first ones in each window. So blocks are scored twice, and each sends a few rows per anchor. The
blocks of anchors are dealt to slots of blocks of rows and are broadcast only if Spark finds
them small enough.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from rallybook.llm import vectors
from rallybook.sources.scratch import stored, work_folder

POSITIVES = 5
NEGATIVES = 10
SCALE = 256
LOWEST, HIGHEST = 30, 90  # percent of the positive's score
BLOCKS_PER_SLOT = 16

BLOCK = "block long, rows array<long>, ids array<long>, labels array<long>, windows array<array<long>>, single boolean, body binary"
PAIR = "anchor long, anchor_id long, score long, negative boolean, id long, row long"


def packed(rows: DataFrame) -> DataFrame:
    """Blocks of rows, an Arrow batch each, with components floor(SCALE * x)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            body, _, single = vectors.packed_body(np.floor(SCALE * vectors.matrix(batch.column("vector"))))
            lists = {"rows": "row", "ids": "vec_id", "labels": "label", "windows": "windows"}
            yield pa.record_batch(
                {
                    "block": pa.array([number], pa.int64()),
                    **{name: vectors.one_list(batch.column(column)) for name, column in lists.items()},
                    "single": pa.array([single]),
                    "body": pa.array([body], pa.binary()),
                }
            )
            number += 1

    return rows.select("row", "vec_id", "label", "windows", "vector").mapInArrow(pack, BLOCK)


class Block:
    def __init__(self, batch: pa.RecordBatch, at: int, prefix: str):
        column = lambda name: batch.column(prefix + name)[at]
        self.rows = column("rows").values.to_numpy(zero_copy_only=False)
        self.ids, self.named = vectors.ids_of(column("ids").values)
        self.labels = column("labels").values.to_numpy(zero_copy_only=False)
        self.windows = column("windows").values
        self.body = vectors.unpacked_body(column("body"), len(self.rows), column("single").as_py())


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole-numbered rows, exact; the shorter ones end in zeros."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    largest = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(width, 1)
    if largest < 2**24:
        return (a.astype(np.float32) @ b.astype(np.float32).T).astype(np.int64)
    if largest < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    exact = whole(a.astype(np.float64)) @ whole(b.astype(np.float64)).T
    if max(map(abs, exact.ravel()), default=0) >= 2**63:
        raise OverflowError("a score does not fit into 64 bits")
    return exact.astype(np.int64)


def first_positives(anchors: Block, i: int, others: Block, score: np.ndarray, most: int) -> np.ndarray:
    same = (others.labels == anchors.labels[i]) & (others.rows != anchors.rows[i])
    return vectors.first_by_score(np.flatnonzero(same), score, others.ids, others.named, most)


def limits(positive_score: int) -> tuple[int, int]:
    """The scores of its negatives; none if the positive's is negative."""
    return -(-LOWEST * positive_score // 100), HIGHEST * positive_score // 100


def first_negatives(anchors: Block, i: int, others: Block, score: np.ndarray, most: int) -> np.ndarray:
    other = others.labels != anchors.labels[i]
    found = []
    for positive_score in set(anchors.windows[i].as_py()):
        low, high = limits(positive_score)
        at = np.flatnonzero(other & (score >= low) & (score <= high))
        found.append(vectors.first_by_score(at, score, others.ids, others.named, most))
    return np.unique(np.concatenate(found))


def met(blocks: DataFrame, anchors: DataFrame) -> DataFrame:
    """Every block of rows beside every block of anchors. Rows stay whole in their slot; the anchors,
    of which there are far fewer, are repeated for each slot."""
    spark = blocks.sparkSession
    count, tasks = blocks.count(), int(spark.conf.get("spark.sql.shuffle.partitions"))
    slots = max(-(-count // BLOCKS_PER_SLOT), min(count, tasks), 1)
    repeated = anchors.select(
        F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot"),
        *[F.col(c).alias(f"a_{c}") for c in anchors.columns],
    )
    dealt = blocks.withColumn("slot", F.pmod(F.xxhash64("block"), F.lit(slots)).cast("int"))
    return dealt.join(repeated, "slot")


def pairs(met_blocks: DataFrame, pick: Callable, most: int, negative: bool) -> DataFrame:
    """Per pair of blocks and anchor, the rows that `pick` picks."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                anchors, others = Block(batch, at, "a_"), Block(batch, at, "")
                scores = products(anchors.body, others.body)
                picked = [pick(anchors, i, others, scores[i], most) for i in range(len(anchors.rows))]
                of = np.repeat(np.arange(len(picked)), [len(p) for p in picked])
                where = np.concatenate([np.zeros(0, np.int64), *picked]).astype(np.int64)
                yield pa.record_batch(
                    {
                        "anchor": pa.array(anchors.rows[of], pa.int64()),
                        "anchor_id": vectors.as_ids(anchors.ids[of], anchors.named[of]),
                        "score": pa.array(scores[of, where], pa.int64()),
                        "negative": pa.array(np.full(len(of), negative)),
                        "id": vectors.as_ids(others.ids[where], others.named[where]),
                        "row": pa.array(others.rows[where], pa.int64()),
                    }
                )

    return met_blocks.mapInArrow(score, PAIR)


def mined(sorted_pairs: DataFrame, most: int) -> DataFrame:
    """The negatives of each window, from the pairs of each anchor by falling score."""
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"

    def mine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, windows = None, []
        for batch in batches:
            out = []
            for anchor, anchor_id, score, negative, id_ in zip(*(c.to_pylist() for c in batch.columns[:5])):
                if anchor != current:
                    current, windows = anchor, []
                if not negative:
                    windows.append([id_, score, *limits(score), 0])
                    continue
                for window in windows:
                    positive_id, positive_score, low, high, found = window
                    if found < most and low <= score <= high:
                        window[4] = found + 1
                        out.append((anchor_id, positive_id, found + 1, id_, positive_score, score))
            columns = list(zip(*out)) or [()] * 6
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names)

    return sorted_pairs.mapInArrow(mine, schema)


def hard_negatives(
    embeddings: DataFrame,
    is_anchor: Column,
    vector: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
) -> DataFrame:
    """`anchor_id`, `positive_id`, `rank`, `negative_id` and both scores, for rows with `vec_id`, `label`
    and `vector`; `is_anchor` is a condition on them.

    Rows with a null label, a null vector or a component that is null or not finite take no part.
    A shorter vector counts as one that ends in zeros, an empty one scores 0. Rows count one by
    one: rows that share a vec_id, or everything, are each a row of their own and each an anchor.
    A row without a vec_id comes after all others of its score; as anchor only if `is_anchor` says so. An
    anchor without positives, a positive whose score is negative, and an empty table give no
    rows. A score beyond 64 bits fails. Other columns are not looked at.
    """
    folder = work_folder(embeddings.sparkSession)
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col(vector).alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
    )
    rows = stored(numbered_rows(rows), f"{folder}/rows")
    nothing = F.array().cast("array<long>")
    blocks = stored(packed(rows.withColumn("windows", nothing)), f"{folder}/blocks")
    anchors = stored(packed(rows.where("is_anchor").withColumn("windows", nothing)), f"{folder}/anchors")
    first = pairs(met(blocks, anchors), first_positives, positives, False)
    order = f"row_number() over (partition by anchor order by score desc, id asc nulls last, row) <= {positives}"
    first = stored(first.withColumn("kept", F.expr(order)).where("kept").drop("kept"), f"{folder}/positives")
    windows = first.groupBy(F.col("anchor").alias("row")).agg(F.collect_list("score").alias("windows"))
    opened = rows.where("is_anchor").join(windows, "row")
    opened = stored(packed(opened), f"{folder}/opened")
    others = pairs(met(blocks, opened), first_negatives, negatives, True)
    # A positive comes before the negatives of its score, so that its window is open.
    key = ["anchor", F.col("score").desc(), "negative", F.col("id").asc_nulls_last(), "row"]
    return mined(first.unionByName(others).repartition("anchor").sortWithinPartitions(*key), negatives)


def numbered_rows(rows: DataFrame) -> DataFrame:
    return vectors.numbered(rows.where(F.col("label").isNotNull() & vectors.finite(F.col("vector"))))

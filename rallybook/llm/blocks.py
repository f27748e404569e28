"""Rows packed into blocks of text, stored so that later joins by block move no text.

A block is one row: the texts of some documents end to end as one binary, where each starts, and
the other columns as a list. Blocks are written once, bucketed by their number; what
later steps find out about a block is small and is brought to it, not the other way round.
"""

from __future__ import annotations

from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from rallybook.llm.text import Texts, PAD

BLOCK_BYTES = 4 << 20


def packed(df: DataFrame, text: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """`block`, `n_bytes`, `start`, `body` and `rest`, the other columns as an array of structs.

    A text longer than `block_bytes` is a block of its own; a null text is an empty one. Numbers
    of blocks depend on the task, so the result has to be stored before it is used twice.
    """
    others = [c for c in df.columns if c != text]
    # A binary column keeps Arrow from checking the text, and batches follow the scan's.
    source = df.select(F.struct(*others).alias("rest"), F.col(text).cast("binary").alias("body"))
    rest = ArrayType(source.schema["rest"].dataType)
    schema = StructType(
        [
            StructField("block", LongType()),
            StructField("n_bytes", LongType()),
            StructField("start", ArrayType(LongType())),
            StructField("body", BinaryType()),
            StructField("rest", rest),
        ]
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        held_bytes = 0

        def flush():
            table = pa.Table.from_batches(held).combine_chunks()
            bodies = table["body"].combine_chunks().cast(pa.large_binary()).fill_null(b"")
            lengths = pc.binary_length(bodies).to_numpy(zero_copy_only=False)
            start = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
            body = b"".join(bodies.to_pylist())
            rest_column = table["rest"].combine_chunks()
            one = pa.array([0, table.num_rows], pa.int32())
            return pa.record_batch(
                {
                    "block": pa.array([number], pa.int64()),
                    "n_bytes": pa.array([len(body)], pa.int64()),
                    "start": pa.array([start], pa.list_(pa.int64())),
                    "body": pa.array([body], pa.binary()),
                    "rest": pa.ListArray.from_arrays(one, rest_column),
                }
            )

        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column("body")), 0)
            sizes = np.cumsum(lengths.to_numpy(zero_copy_only=False))
            done = 0
            while done < batch.num_rows:
                before = sizes[done - 1] if done else 0
                fits = int(np.searchsorted(sizes, before + block_bytes - held_bytes, side="right"))
                upto = max(fits, done + (not held))
                if upto > done:
                    held.append(batch.slice(done, upto - done))
                    held_bytes += int(sizes[upto - 1] - before)
                    done = upto
                if done < batch.num_rows:
                    yield flush()
                    number, held, held_bytes = number + 1, [], 0
        if held:
            yield flush()

    return source.mapInArrow(pack, schema)


def stored_blocks(df: DataFrame, text: str, folder: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """`packed`, written below `folder` bucketed by `block`, so that a join on it needs no exchange
    of the blocks."""
    spark = df.sparkSession
    name = f"rallybook_blocks_{uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = packed(df, text, block_bytes).write.format("parquet").option("compression", "zstd")
    writer.option("path", f"{folder}/{name}").bucketBy(buckets, "block").saveAsTable(name)
    blocks = spark.table(name)
    # The plan holds files and bucketing by itself; only the catalogue forgets the name.
    spark.sql(f"DROP TABLE {name}")
    return blocks


def with_facts(blocks: DataFrame, facts: DataFrame, name: str) -> DataFrame:
    """Blocks with the array `name`, the structs gathered from the rows of `facts` for the block."""
    columns = [c for c in facts.columns if c != "block"]
    gathered = facts.groupBy("block").agg(F.collect_list(F.struct(*columns)).alias(name))
    return blocks.join(gathered.hint("shuffle_hash"), "block", "left")


def texts_of(batch: pa.RecordBatch, row: int) -> Texts:
    body = np.frombuffer(batch.column("body")[row].as_buffer(), np.uint8)
    start = batch.column("start")[row].values.to_numpy(zero_copy_only=False)
    return Texts(np.concatenate([body, np.zeros(PAD, np.uint8)]), start)


def facts_of(batch: pa.RecordBatch, row: int, name: str) -> dict[str, np.ndarray] | None:
    """The structs as one array per field; None if there are none."""
    facts = batch.column(name)[row].values
    if facts is None or not len(facts):
        return None
    fields = [facts.type.field(i).name for i in range(facts.type.num_fields)]
    return {f: facts.field(f).to_numpy(zero_copy_only=False) for f in fields}

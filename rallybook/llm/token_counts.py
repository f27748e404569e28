"""Operator 3: tokens per document of flat, unindexed token files, by a separator scan.

A flat token file is nothing but ids of fixed width, documents end to end, each followed by the
end-of-document id. The scan cuts a file into blocks, finds the separators of each block
with one vectorised comparison, and keeps per block only where documents begin. Documents that run
over the end of a block are stitched by scans over the blocks of a file: the running count of
documents before numbers them, and the first separator after closes the last one of a block.

Files are read whole by a task, so they should be of moderate size, as `write_token_files` makes
them: one per input partition. `BLOCK_TOKENS` bounds what is compared at once.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from rallybook.llm.text import flat_texts, slices

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how the vocabulary splits text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BLOCK_TOKENS = 1 << 20
END = 0
ID_TOKENS = 5
BATCH_BYTES = 4 << 20
# Blanks as the pattern means them; on a run of a million the matcher's stack overflows.
LONG_BLANKS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{50000,}")


def tokenizer(path: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("flat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded(encoding, text: str) -> list[int]:
    """The tokens of a text. Long runs of blanks do not go through the pattern, which would give each of them as
    one piece, without its last blank if a word follows, and go on with that."""
    out, at = [], 0
    for run in LONG_BLANKS.finditer(text):
        stop = run.end() - (run.end() < len(text))
        out += encoding.encode_ordinary(text[at : run.start()])
        out += encoding._encode_single_piece(text[run.start() : stop])
        at = stop
    return out + encoding.encode_ordinary(text[at:])


def id_tokens(ids: np.ndarray) -> np.ndarray:
    """A bigint as five tokens of 13 bits each, none of them `END`. The highest bit is not used by any."""
    parts = [(ids.astype(np.uint64) >> np.uint64(13 * i)) & np.uint64(0x1FFF) for i in range(ID_TOKENS)]
    return (np.stack(parts, axis=1) + np.uint64(1)).astype("<u2")


# In place of a null id: the one bit that ids do not use.
NO_ID = np.array([1] * (ID_TOKENS - 1) + [(1 << 12) + 1], "<u2")


def from_id_tokens(tokens: Column) -> Column:
    """The bigint whose five tokens these are, null if they are those of no id."""
    parts = [F.shiftleft(F.element_at(tokens, i + 1).cast("long") - 1, 13 * i) for i in range(ID_TOKENS)]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.bitwiseOR(part)
    return F.when(F.element_at(tokens, ID_TOKENS) != int(NO_ID[-1]), whole)


def write_token_files(docs: DataFrame, path: str, vocabulary: str = VOCABULARY, nameless: bool = False) -> None:
    """Tokenise whole texts into flat files of 16-bit ids. Ids are stored plus one, so that 0 ends a
    document; each document begins with its doc_id as `ID_TOKENS` tokens. Null texts have no tokens.
    Rows without a doc_id are written only if `nameless`, and begin with `NO_ID`.

    A text sink writes them: a line is a document's ids, and the line separator the bytes of `END`.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = tokenizer(vocabulary)
        for batch in slices(batches, "text", BATCH_BYTES):
            ids = batch.column("doc_id").cast(pa.int64())
            heads = id_tokens(ids.fill_null(0).to_numpy(zero_copy_only=False))
            heads[ids.is_null().to_numpy(zero_copy_only=False)] = NO_ID
            lines = []
            for head, text in zip(heads, batch.column("text")):
                ids = np.array(encoded(encoding, text.as_py() or ""), np.int64) + 1
                lines.append(head.tobytes() + ids.astype("<u2").tobytes())
            yield pa.record_batch({"value": pa.array(lines, pa.binary())})

    docs = docs if nameless else docs.where("doc_id is not null")
    rows = docs.select("doc_id", "text").mapInArrow(encode, "value binary")
    rows.select(F.col("value").cast("string")).write.option("lineSep", "\0\0").text(path)


def separator_scan(
    spark: SparkSession, path: str, end: int = END, width: int = 2, head: int = 0, block_tokens: int = BLOCK_TOKENS
) -> DataFrame:
    """`file`, `document` (its number in the file), `start` (in tokens), `n_tokens` without the end
    marker, and its first `head` tokens as `first`, for all documents of all files below `path`.

    Two end markers in a row enclose an empty document. What follows the last end marker of a file, if
    anything, is a document too. Empty files have none. A file with part of a token fails.
    """
    kind = {2: "<u2", 4: "<u4"}[width]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("path"), batch.column("content")):
                ids = np.frombuffer(content.as_buffer(), kind)
                blocks = range(0, len(ids), block_tokens)
                ends = [np.flatnonzero(ids[at : at + block_tokens] == end) + at for at in blocks]
                # A block answers for the documents that begin in it; one that would begin at the end does not.
                starts = [e + 1 for e in ends]
                if len(ids):
                    starts[0] = np.concatenate([[0], starts[0]])
                starts = [s[s < len(ids)] for s in starts]
                firsts = [[ids[a : a + head].tolist() for a in s.tolist()] for s in starts]
                yield pa.record_batch(
                    {
                        "file": pa.array([file.as_py()] * len(ends), pa.string()),
                        "block": pa.array(range(len(ends)), pa.int32()),
                        "size": pa.array([len(ids)] * len(ends), pa.int64()),
                        "ends": pa.array(ends, pa.list_(pa.int64())),
                        "starts": pa.array(starts, pa.list_(pa.int64())),
                        "firsts": pa.array(firsts, pa.list_(pa.list_(pa.int32()))),
                    }
                )

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    schema = "file string, block int, size long, ends array<long>, starts array<long>, firsts array<array<int>>"
    blocks = files.mapInArrow(scan, schema)
    order = Window.partitionBy("file").orderBy("block")
    before = F.sum(F.size("starts")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    backwards = Window.partitionBy("file").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    after = F.min(F.get("ends", F.lit(0))).over(backwards)
    stitched = blocks.withColumns({"before": F.coalesce(before, F.lit(0)), "after": F.coalesce(after, F.col("size"))})
    # A document ends at the next separator. In a file's first block one begins before the first of them.
    closed, own = F.concat("ends", F.array("after")), F.size("starts")
    stops = F.when(own > 0, F.slice(closed, F.when(F.col("block") == 0, 1).otherwise(2), own))
    zipped = F.arrays_zip("starts", stops.alias("stops"), "firsts")
    docs = stitched.select("file", "before", F.posexplode(zipped).alias("i", "d"))
    return docs.select(
        "file",
        (F.col("before") + F.col("i")).alias("document"),
        F.col("d.starts").alias("start"),
        (F.col("d.stops") - F.col("d.starts")).alias("n_tokens"),
        F.col("d.firsts").alias("first"),
    )

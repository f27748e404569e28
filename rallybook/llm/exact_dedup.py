"""Operator 1: exact passages that repeat across documents, by blockwise sorting of suffix hashes.

Suffixes are compared to a depth of `length` bytes. A difference cover D of period v picks the
sample suffixes of every document: those at offsets that are in D modulo v. For any two suffixes
there is a distance below v at which both meet a sample, so two that agree on `length` bytes meet
samples that agree on length - v + 1. The samples are sorted first by hash, one bucket at a
time; no ranks are kept, only one bit goes back: whether documents share the sample. A suffix whose next
v bytes hold no shared sample cannot repeat in another document: that settles most of
them unsorted. Ties of the others are settled by hash, not by ranks of the cover.

The others form runs of neighbours. Runs are cut where the content says so, into pieces, and equal
pieces are reduced to the one of their smallest document; its copies are removed whole. What is left are
the suffixes of distinct pieces. They are sorted in two steps, again one bucket at a time: by a
short key to drop those without a partner, then by 96 bits of hash to find for each class of equal
suffixes the smallest document, which keeps it. The short keys have 10 bits more than the number of
entries, so that one in a thousand is taken along for nothing; they decide nothing.

What a block of 4 MB sends has one entry per distinct key, so a passage in a third
of all documents weighs no more than one per block. Memory is bounded by a block or a bucket.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from rallybook.llm.blocks import facts_of, stored_blocks, texts_of, with_facts
from rallybook.llm.text import GOLDEN, MIX_B, U, Texts, hash_grams, mix, words_at
from rallybook.sources.scratch import stored, work_folder

LENGTH = 50
# A perfect difference set: each residue modulo 31 is a difference of two of its members.
PERIOD, COVER = 31, (1, 5, 11, 24, 25, 27)
KEYS_PER_BUCKET = 3_000_000
PIECE = 64
MAX_PIECE = 4096
NO_ID = np.iinfo(np.int64).max


def key_bits(entries: float) -> int:
    return min(60, math.ceil(math.log2(max(entries, 2))) + 10)


def sample_keys(texts: Texts, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of the sample suffixes, the document of each, and the hashes of their first bytes."""
    usable = np.maximum(texts.lengths - (length - PERIOD), 0)
    periods = int(usable.max(initial=0)) // PERIOD + 1
    offsets = (np.arange(periods)[:, None] * PERIOD + np.array(COVER)).ravel()
    counts = np.searchsorted(offsets, usable)
    doc = np.repeat(np.arange(len(counts)), counts)
    at = np.concatenate([offsets[:c] for c in counts.tolist()] or [offsets[:0]]) + texts.start[:-1][doc]
    return at, doc, hash_grams(texts.buf, at, length - PERIOD + 1)


@dataclass
class Classes:
    """Entries by key: the distinct keys in order, the class of each entry, and the smallest and
    largest document of each class."""

    keys: np.ndarray
    of: np.ndarray
    low: np.ndarray
    high: np.ndarray


def classes(keys: np.ndarray, ids: np.ndarray | None = None) -> Classes:
    """Without ids only the keys are told apart."""
    if not len(keys):
        return Classes(keys, *[np.zeros(0, np.int64)] * 3)
    order = np.argsort(keys)
    ranked = keys[order]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    first = np.flatnonzero(new)
    of = np.empty(len(keys), np.int64)
    of[order] = np.cumsum(new) - 1
    if ids is None:
        return Classes(ranked[first], of, first, first)
    owner = ids[order]
    return Classes(ranked[first], of, np.minimum.reduceat(owner, first), np.maximum.reduceat(owner, first))


def deltas(keys: np.ndarray) -> bytes:
    """Ascending keys as differences in byte planes, compressed."""
    steps = np.diff(keys, prepend=U(0))
    return zstandard.compress(steps.view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def from_deltas(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(U).ravel(), dtype=U)


def bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def from_bits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


def buckets_for(entries: float) -> int:
    """How many buckets keep each within `KEYS_PER_BUCKET`, as a power of two."""
    return 1 << max(0, math.ceil(math.log2(max(entries, 1) / KEYS_PER_BUCKET)))


def used_buckets(keys: np.ndarray, buckets: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The equal ranges of a key space of `width` bits that ascending keys fall into, and where the keys of each
    begin, with the end of the last. Takes as long as there are keys, however many buckets."""
    shift = width - int(math.log2(buckets))
    if buckets < len(keys):
        at = np.searchsorted(keys, np.arange(buckets, dtype=U) << U(shift)) if buckets > 1 else np.zeros(1, np.int64)
        used = np.flatnonzero(np.diff(at, append=len(keys)))
        return used, np.append(at[used], len(keys))
    bucket = keys >> U(shift) if shift < 64 else np.zeros(len(keys), U)
    begins = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])[: len(keys)])
    return bucket[begins].astype(np.int64), np.append(begins, len(keys))


def by_bucket(keys: np.ndarray, facts: dict | None, name: str, buckets: int, width: int) -> np.ndarray:
    """The bits that came back per bucket as one flag per key."""
    flags = np.zeros(len(keys), bool)
    if facts is not None:
        used, at = used_buckets(keys, buckets, width)
        for i, data in zip(np.searchsorted(used, facts["bucket"]).tolist(), facts[name]):
            flags[at[i] : at[i + 1]] = from_bits(data, at[i + 1] - at[i])
    return flags


def doc_ids(batch: pa.RecordBatch, row: int) -> np.ndarray:
    """Ids of a block's documents; no id counts as larger than any."""
    ids = batch.column("rest")[row].values.field("doc_id")
    return ids.cast(pa.int64()).fill_null(NO_ID).to_numpy(zero_copy_only=False)


def narrow(blocks: DataFrame) -> DataFrame:
    """Blocks without the columns that only pass through."""
    return blocks.withColumn("rest", F.transform("rest", lambda r: F.struct(r["doc_id"].alias("doc_id"))))


def shared_keys(blocks: DataFrame, key_classes: Callable, buckets: int, width: int) -> DataFrame:
    """`block`, `bucket` and `shared`: one bit per distinct key of the block, whether another
    document has it. `key_classes(batch, row)` gives the classes of a block."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                found = key_classes(batch, row)
                used, at = used_buckets(found.keys, buckets, width)
                parts = [slice(a, b) for a, b in zip(at[:-1], at[1:])]
                known = found.low != found.high
                yield pa.record_batch(
                    {
                        "bucket": pa.array(used, pa.int32()),
                        "block": pa.array([batch.column("block")[row].as_py()] * len(used), pa.int64()),
                        "keys": pa.array([deltas(found.keys[p]) for p in parts], pa.binary()),
                        "known": pa.array([bits(known[p]) for p in parts], pa.binary()),
                    }
                )

    def rank(table: pa.Table) -> pa.Table:
        keys = [from_deltas(x.as_py()) for x in table["keys"]]
        known = [from_bits(x.as_py(), len(k)) for x, k in zip(table["known"], keys)]
        every = np.concatenate(keys)
        order = np.argsort(every)
        ranked, hit = every[order], np.concatenate(known)[order]
        first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        count = np.diff(np.append(first, len(ranked)))
        hit = np.repeat((count > 1) | np.logical_or.reduceat(hit, first), count)
        shared = np.empty(len(hit), bool)
        shared[order] = hit
        ends = np.cumsum([len(k) for k in keys])[:-1]
        return pa.table(
            {
                "block": table["block"],
                "bucket": table["bucket"],
                "shared": pa.array([bits(x) for x in np.split(shared, ends)], pa.binary()),
            }
        )

    sent = blocks.mapInArrow(send, "bucket int, block long, keys binary, known binary")
    return sent.groupBy("bucket").applyInArrow(rank, "block long, bucket int, shared binary")


def candidate_pieces(blocks: DataFrame, total: int, length: int) -> DataFrame:
    """The suffixes left to sort, as pieces of neighbouring ones: `block`, `doc` (its place in the
    block), `doc_id`, `at` (offset of the first suffix in the document), `n` suffixes and a
    128-bit key of the text that they span."""
    entries = total * len(COVER) / PERIOD
    buckets, width = buckets_for(entries), key_bits(entries)
    slim = narrow(blocks).drop("n_bytes")

    def samples(batch, row):
        _, doc, keys = sample_keys(texts_of(batch, row), length)
        return classes(keys >> U(64 - width), doc_ids(batch, row)[doc])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                facts = facts_of(batch, row, "samples")
                if facts is None:
                    continue
                texts = texts_of(batch, row)
                at, _, keys = sample_keys(texts, length)
                found = classes(keys >> U(64 - width))
                hit = at[by_bucket(found.keys, facts, "shared", buckets, width)[found.of]]
                # Suffixes within a period before a shared sample, in the same document and long enough.
                edge = np.zeros(int(texts.start[-1]) + 1, np.int32)
                edge[hit + 1] = -1
                low = np.maximum(hit - (PERIOD - 1), texts.start[np.searchsorted(texts.start, hit, side="right") - 1])
                np.add.at(edge, low, 1)
                near = np.cumsum(edge, dtype=np.int32) > 0
                for begin, end in zip(texts.start[:-1].tolist(), texts.start[1:].tolist()):
                    near[max(end - length + 1, begin) : end] = False
                place = np.flatnonzero(near)
                if len(place):
                    yield cut_pieces(batch, row, texts, place, length)

    facts = shared_keys(slim, samples, buckets, width)
    schema = "block long, doc int, doc_id long, at int, n int, key_a long, key_b long"
    return with_facts(slim, facts, "samples").mapInArrow(pieces, schema)


def cut_pieces(batch, row: int, texts: Texts, place: np.ndarray, length: int) -> pa.RecordBatch:
    """Runs of neighbouring suffixes cut before every suffix whose hash ends in zeros, so that equal
    passages are cut alike, and at the latest after `MAX_PIECE`."""
    tie = hash_grams(texts.buf, place, length)
    doc = np.searchsorted(texts.start, place, side="right") - 1
    new = np.concatenate([[True], (np.diff(place) != 1) | (np.diff(doc) != 0)])
    new |= tie % U(PIECE) == 0
    begins = np.flatnonzero(new)
    within = np.arange(len(place)) - np.repeat(begins, np.diff(np.append(begins, len(place))))
    begins = np.flatnonzero(within % MAX_PIECE == 0)
    count = np.diff(np.append(begins, len(place)))
    index = (np.arange(len(place)) - np.repeat(begins, count)).astype(U)
    salt = mix(count.astype(U))
    key_a = np.add.reduceat(mix(tie + index * GOLDEN), begins) ^ salt
    key_b = np.add.reduceat(mix(~tie + index * MIX_B), begins) ^ salt
    doc, first = doc[begins], place[begins]
    return pa.record_batch(
        {
            "block": pa.array([batch.column("block")[row].as_py()] * len(begins), pa.int64()),
            "doc": pa.array(doc.astype(np.int32)),
            "doc_id": pa.array(doc_ids(batch, row)[doc]),
            "at": pa.array((first - texts.start[doc]).astype(np.int32)),
            "n": pa.array(count.astype(np.int32)),
            "key_a": pa.array(key_a.view(np.int64)),
            "key_b": pa.array(key_b.view(np.int64)),
        }
    )


@dataclass
class Suffixes:
    """The suffixes of a block's leading pieces: where they start, their document, their hash."""

    at: np.ndarray
    owner: np.ndarray
    tie: np.ndarray


def leading_suffixes(batch: pa.RecordBatch, row: int, texts: Texts, length: int) -> Suffixes:
    facts = facts_of(batch, row, "leading")
    if facts is None:
        empty = np.zeros(0, np.int64)
        return Suffixes(empty, empty, empty.view(U))
    first, count = texts.start[facts["doc"]] + facts["at"], facts["n"].astype(np.int64)
    begins = np.cumsum(count) - count
    at = np.arange(int(count.sum())) + np.repeat(first - begins, count)
    owner = np.repeat(doc_ids(batch, row)[facts["doc"]], count)
    return Suffixes(at, owner, hash_grams(texts.buf, at, length))


def tails(texts: Texts, at: np.ndarray, length: int) -> np.ndarray:
    """32 bits of a second hash, of the same bytes in another order."""
    loads, tail = words_at(texts.buf), np.zeros(len(at), U)
    for step in (length - 8, *range((length - 8) % 8, length - 8, 8), 0):
        tail = (tail ^ loads[at + step]) * MIX_B
        tail ^= tail >> U(29)
    return tail >> U(32)


def pair_order(tie: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """An order by tie, then tail. Ties with different tails are next to never met, so sorting by one
    of them does as a rule."""
    order = np.argsort(tie)
    a, b = tie[order], tail[order]
    if ((a[1:] == a[:-1]) & (b[1:] != b[:-1])).any():
        return np.lexsort((tail, tie))
    return order


def covered_suffixes(blocks: DataFrame, folder: str, length: int) -> tuple[DataFrame, Callable]:
    """Blocks with `leading` pieces plus what was found out about their suffixes in buckets, and
    the function that tells from it where those start that a smaller document has too."""
    total = blocks.selectExpr("sum(aggregate(leading, 0L, (s, p) -> s + p.n)) as n").first()[0] or 0
    buckets, width = buckets_for(total), key_bits(total)

    def short_classes(batch, row) -> tuple[Texts, Suffixes, Classes]:
        texts = texts_of(batch, row)
        found = leading_suffixes(batch, row, texts, length)
        return texts, found, classes(found.tie >> U(64 - width), found.owner)

    def shared_classes(batch, row):
        """The suffixes whose short key another document has, by class of their long key."""
        texts, found, short = short_classes(batch, row)
        hit = by_bucket(short.keys, facts_of(batch, row, "partners"), "shared", buckets, width)
        pick = np.flatnonzero(hit[short.of])
        at, tie, owner = found.at[pick], found.tie[pick], found.owner[pick]
        tail = tails(texts, at, length)
        order = pair_order(tie, tail)
        at, tie, tail, owner = at[order], tie[order], tail[order], owner[order]
        first, of = firsts(tie, tail)
        least = np.minimum.reduceat(owner, first) if len(first) else owner
        return at, owner, tie[first], tail[first], least, of

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                _, _, tie, tail, least, _ = shared_classes(batch, row)
                used, at = used_buckets(tie, buckets, 64)
                parts = [slice(a, b) for a, b in zip(at[:-1], at[1:])]

                def packed(column):
                    return pa.array([zstandard.compress(column[p].tobytes(), 1) for p in parts], pa.binary())

                yield pa.record_batch(
                    {
                        "bucket": pa.array(used, pa.int32()),
                        "block": pa.array([batch.column("block")[row].as_py()] * len(used), pa.int64()),
                        "tie": pa.array([deltas(tie[p]) for p in parts], pa.binary()),
                        "tail": packed(tail.astype(np.uint32)),
                        "owner": packed(least),
                    }
                )

    def sort(table: pa.Table) -> pa.Table:
        def column(name, kind):
            return np.concatenate([np.frombuffer(zstandard.decompress(x.as_py()), kind) for x in table[name]])

        ties = [from_deltas(x.as_py()) for x in table["tie"]]
        tie, tail, owner = np.concatenate(ties), column("tail", np.uint32), column("owner", np.int64)
        order = pair_order(tie, tail)
        owner = owner[order]
        first, of = firsts(tie[order], tail[order])
        earlier = np.empty(len(order), bool)
        earlier[order] = np.minimum.reduceat(owner, first)[of] < owner
        ends = np.cumsum([len(t) for t in ties])[:-1]
        return pa.table(
            {
                "block": table["block"],
                "bucket": table["bucket"],
                "earlier": pa.array([bits(x) for x in np.split(earlier, ends)], pa.binary()),
            }
        )

    partners = shared_keys(blocks, lambda batch, row: short_classes(batch, row)[2], buckets, width)
    paired = with_facts(blocks, stored(partners, f"{folder}/partners"), "partners")
    sent = paired.mapInArrow(send, "bucket int, block long, tie binary, tail binary, owner binary")
    earlier = sent.groupBy("bucket").applyInArrow(sort, "block long, bucket int, earlier binary")

    def gone_from(batch: pa.RecordBatch, row: int) -> np.ndarray:
        at, owner, tie, _, least, of = shared_classes(batch, row)
        # A class is older than its smallest owner in this block, or that owner is another document.
        older = by_bucket(tie, facts_of(batch, row, "earlier"), "earlier", buckets, 64)
        return at[older[of] | (least[of] < owner)]

    return with_facts(paired, earlier, "earlier"), gone_from


def firsts(tie: np.ndarray, tail: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted pairs, where each distinct one begins and the class of each."""
    new = np.ones(len(tie), bool)
    new[1:] = (tie[1:] != tie[:-1]) | (tail[1:] != tail[:-1])
    return np.flatnonzero(new), np.cumsum(new) - 1


def repeated_passages(docs: DataFrame, length: int = LENGTH, whole_characters: bool = False) -> DataFrame:
    """The documents without what smaller documents already say.

    Every byte is removed that is covered by `length` bytes which also start in a document with a
    smaller doc_id; passages are judged on the input. Result: the columns of the input, `text`
    replaced by `kept` (binary: a cut may fall inside a character), and `n_bytes`, `n_removed` and
    `spans`, the maximal removed runs as (start, length) in bytes.

    Null text: empty, nothing removed. Null doc_id: counts as larger than every id, so its text
    gives way to all others and takes nothing from them. `whole_characters` spares the bytes of
    characters that a cut would split, so that `kept` is valid UTF-8 if the text is. Rows with the same doc_id are
    one document: they take nothing from each other. Texts shorter than `length` stay whole. An
    empty table gives an empty result. Input columns named like result columns are replaced.
    """
    if length < PERIOD + 7:
        raise ValueError(f"length must be at least {PERIOD + 7}")
    folder = work_folder(docs.sparkSession)
    docs = docs.drop("kept", "n_bytes", "n_removed", "spans")
    blocks = stored_blocks(docs.withColumn("doc_id", F.col("doc_id").cast("long")), "text", folder)
    total = blocks.agg(F.sum("n_bytes")).first()[0] or 0
    pieces = stored(candidate_pieces(blocks, total, length), f"{folder}/pieces")
    leaders = pieces.groupBy("key_a", "key_b").agg(F.min("doc_id").alias("leader"))
    known = pieces.join(leaders, ["key_a", "key_b"])
    known = known.select("block", "doc", "at", "n", (F.col("doc_id") > F.col("leader")).alias("copy"))
    known = stored(known, f"{folder}/known")
    leading = with_facts(blocks, known.where("not copy").drop("copy"), "leading")
    classed, gone_from = covered_suffixes(leading, folder, length)
    classed = with_facts(classed, known.where("copy").drop("copy"), "copies")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                yield cut_block(batch, row, gone_from(batch, row), length, whole_characters)

    fields = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in blocks.schema["rest"].dataType.elementType.fields)
    schema = f"rest struct<{fields}>, kept binary, n_bytes long, n_removed long, spans array<struct<start: long, length: long>>"
    return classed.mapInArrow(cut, schema).select("rest.*", "kept", "n_bytes", "n_removed", "spans")


def cut_block(
    batch: pa.RecordBatch, row: int, gone_at: np.ndarray, length: int, whole_characters: bool
) -> pa.RecordBatch:
    """The block's documents without the suffixes' bytes, given those that go, and the copies."""
    texts, copies = texts_of(batch, row), facts_of(batch, row, "copies")
    n = int(texts.start[-1])
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, gone_at, 1)
    np.subtract.at(edge, gone_at + length, 1)
    if copies is not None:
        first = texts.start[copies["doc"]] + copies["at"]
        np.add.at(edge, first, 1)
        np.subtract.at(edge, first + copies["n"] + length - 1, 1)
    gone = np.cumsum(edge)[:n] > 0
    if whole_characters and n:
        begins = np.flatnonzero((texts.buf[:n] & 0xC0) != 0x80)
        begins = begins if len(begins) and begins[0] == 0 else np.concatenate([[0], begins])
        gone = np.repeat(np.logical_and.reduceat(gone, begins), np.diff(np.append(begins, n)))
    limit = np.zeros(n + 1, bool)
    limit[texts.start] = True
    begin, finish = gone.copy(), gone.copy()
    begin[1:] &= ~gone[:-1] | limit[1:n]
    finish[:-1] &= ~gone[1:] | limit[1:n]
    begins, ends = np.flatnonzero(begin), np.flatnonzero(finish) + 1
    in_doc = begins - texts.start[np.searchsorted(texts.start, begins, side="right") - 1]
    removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[texts.start])
    kept, body = [], texts.buf[:n]
    for a, b, cut in zip(texts.start[:-1].tolist(), texts.start[1:].tolist(), removed.tolist()):
        kept.append((body[a:b][~gone[a:b]] if cut else body[a:b]).tobytes())
    spans = pa.StructArray.from_arrays(
        [pa.array(in_doc, pa.int64()), pa.array(ends - begins, pa.int64())], ["start", "length"]
    )
    of = pa.array(np.searchsorted(begins, texts.start), pa.int32())
    return pa.record_batch(
        {
            "rest": batch.column("rest")[row].values,
            "kept": pa.array(kept, pa.binary()),
            "n_bytes": pa.array(texts.lengths, pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
            "spans": pa.ListArray.from_arrays(of, spans),
        }
    )

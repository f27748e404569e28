"""Operator 2: near-duplicate documents, by an LSH forest of min-hash signatures.

A document is the set of its distinct 5-word shingles. Documents with the same set are one node. A
node's signature has 128 min-hashes; each of 32 trees orders the nodes by four of them, then by
the following ones. Nodes that agree on a tree's four form a region. Two nodes of similarity 0.75
miss each other in all trees with probability (1 - 0.75^4)^32, 5 in a million, and 3
in a hundred million at 0.8.

What is compared depends on how crowded a region is. In small ones all pairs are candidates. In
larger ones these are first the neighbours in the order, which share the longest prefixes, and each
node with the region's smallest. Candidates whose signatures agree in fewer than 66 of 128
places are dropped (a similarity of 0.75 does so once in 100 million). A few per node
are confirmed on full shingle sets, and their components found. Only then are other
pairs of larger regions formed, and only between different components, so a region of copies costs
nothing more. They are weighed by one bit of each of 4096 min-hashes, which keeps a similarity of
0.75 but for three in ten million and drops nearly all below 0.67. Where many pairs would be left, as among
pages of one template, only nodes meet that share a rare shingle: if each set is ordered from its rarest shingle
to its commonest, two of similarity 0.75 share one among the first quarter of each, and among the first seventh of the
smaller. Groups that are still large are divided by the sizes of the sets, as sizes too far apart rule a pair out. Two blocks
of a group meet in a task of their own, so no task holds a region, however crowded. All pairs that remain
are confirmed, none are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rallybook.llm.graph import components
from rallybook.llm.text import GOLDEN, LOWER, U, Texts, flat_texts, hash_spans, mix, slices, split_words
from rallybook.sources.scratch import stored, work_folder

SHINGLE = 5
PERCENT = 75
TREES, DEPTH = 32, 4
PLACES = TREES * DEPTH
LEAST_AGREEING = 66
SMALL_REGION = 8
SLOT_NODES = 4096
BLOCK_NODES = 2048
PAIRS_PER_NODE = 2048
# Regions with more pairs a node are searched by rare shingles. Those are told by counts of this many slots.
CROWD_PAIRS = 256
SLOT_BITS = 18
# Sets of similarity 0.75 differ in size by a third at most, so by one step of this ratio.
SIZE_STEP = 1.34
BITS = 4096
MOST_DIFFERING = 618
BATCH_BYTES = 8 << 20

FACTORS = np.random.default_rng(20).integers(0, 1 << 32, (2, PLACES), dtype=np.uint64).astype(np.uint32)
FACTORS[0] |= 1
ODD = mix(np.arange(1, SHINGLE + 1, dtype=U) * GOLDEN) | U(1)


def shingle_sets(texts: Texts) -> list[np.ndarray]:
    """The distinct shingles of each text as ascending 64-bit hashes. A text of fewer words has all
    of them as its one shingle, a text without words has none."""
    lowered = Texts(LOWER[texts.buf], texts.start)
    words = split_words(lowered)
    h = hash_spans(lowered.buf, words.start, words.end)
    grams = np.zeros(max(len(h) - SHINGLE + 1, 0), U)
    for i in range(SHINGLE):
        grams += h[i : i + len(grams)] * ODD[i]
    grams = mix(grams)
    sets = []
    for a, b in zip(words.of[:-1].tolist(), words.of[1:].tolist()):
        if b - a >= SHINGLE:
            sets.append(np.unique(grams[a : b - SHINGLE + 1]))
        elif b > a:
            sets.append(mix(np.array([(h[a:b] * ODD[: b - a]).sum() + U(b - a)], U)))
        else:
            sets.append(np.zeros(0, U))
    return sets


def signature(shingles: np.ndarray) -> np.ndarray:
    least = np.full(PLACES, 0xFFFFFFFF, np.uint32)
    short = (shingles >> U(32)).astype(np.uint32)
    for at in range(0, len(short), 1 << 12):
        hashed = short[at : at + (1 << 12), None] * FACTORS[0] + FACTORS[1]
        np.minimum(least, hashed.min(axis=0), out=least)
    return least


def sketches(docs: DataFrame) -> DataFrame:
    """Per document the size of its set, a 128-bit key of it, and its signature."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            sets = shingle_sets(flat_texts(batch.column("text")))
            size = np.array([len(s) for s in sets], np.int64)
            keys = np.array([[mix(s).sum(dtype=U), mix(~s).sum(dtype=U)] for s in sets], U).reshape(-1, 2)
            keys = mix(keys ^ size[:, None].astype(U)).view(np.int64)
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_shingles": pa.array(size),
                    "key_a": pa.array(keys[:, 0]),
                    "key_b": pa.array(keys[:, 1]),
                    "signature": pa.array([signature(s).tobytes() for s in sets], pa.binary()),
                }
            )

    return docs.mapInArrow(sketch, "doc_id long, n_shingles long, key_a long, key_b long, signature binary")


def matrix(column: pa.Array, kind, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), width)


def region_keys(places: np.ndarray) -> np.ndarray:
    """The key of every node in every tree, from its places by tree."""
    key = np.broadcast_to(mix(np.arange(1, TREES + 1, dtype=U)), places.shape[:2])
    for i in range(DEPTH):
        key = mix(key ^ places[:, :, i])
    return key


def forest(nodes: DataFrame) -> DataFrame:
    """A row per node and tree: `key` of its region, and `deep`, the places that follow, for the
    order within the region."""

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                places = matrix(part.column("signature"), np.uint32, PLACES).astype(U).reshape(-1, TREES, DEPTH)
                key = region_keys(places)
                after = np.roll(places, -1, axis=1) >> U(24)
                deep = (after[..., 0] << U(24)) | (after[..., 1] << U(16)) | (after[..., 2] << U(8)) | after[..., 3]
                yield pa.record_batch(
                    {
                        "key": pa.array(key.ravel().view(np.int64)),
                        "node": pa.array(np.repeat(part.column("node").to_numpy(), TREES)),
                        "deep": pa.array(deep.ravel().astype(np.int64)),
                    }
                )

    return nodes.mapInArrow(plant, "key long, node long, deep long")


def crowded(rows: DataFrame) -> DataFrame:
    """The rows of regions with two nodes or more, with the `size` of the region. Hot regions are
    counted before any shuffle."""
    sizes = rows.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    return rows.join(sizes, "key")


def neighbours(regions: DataFrame) -> DataFrame:
    """Candidate pairs (a, b), a < b, with what is needed to weigh them."""
    one = F.struct("node", "n", "sketch")
    named = regions.select("key", "size", "deep", one.alias("it"))
    small = named.where(F.col("size") <= SMALL_REGION).select("key", "it")
    pairs = small.withColumnRenamed("it", "a").join(small.withColumnRenamed("it", "b"), "key")
    pairs = pairs.where("a.node < b.node").select("a", "b")
    large = named.where(F.col("size") > SMALL_REGION)
    hubs = large.groupBy("key").agg(F.min("it").alias("hub"))
    starred = large.select("key", "it").join(hubs, "key").where("it.node != hub.node")
    starred = starred.select(F.col("hub").alias("a"), F.col("it").alias("b"))
    # Very large regions are ordered in slots of neighbouring prefixes, not in one task.
    slots = F.ceil(F.col("size") / SLOT_NODES)
    ordered = large.withColumn("slot", F.shiftright(F.col("deep") * slots, 32))
    before = ordered.selectExpr(
        "it as b", "lag(it) over (partition by key, slot order by deep, it.node) as a"
    ).where("a is not null and a.node != b.node")
    before = before.select(
        F.when(F.expr("a.node < b.node"), F.col("a")).otherwise(F.col("b")).alias("a"),
        F.when(F.expr("a.node < b.node"), F.col("b")).otherwise(F.col("a")).alias("b"),
    )
    return pairs.union(starred).union(before)


def alike(pairs: DataFrame) -> DataFrame:
    """Distinct pairs whose sizes allow for the similarity and whose signatures speak for it."""
    flat = pairs.select(
        F.col("a.node").alias("a"),
        F.col("b.node").alias("b"),
        F.col("a.sketch").alias("sketch_a"),
        F.col("b.sketch").alias("sketch_b"),
        F.col("a.n").alias("n_a"),
        F.col("b.n").alias("n_b"),
    ).where(f"100 * least(n_a, n_b) >= {PERCENT} * greatest(n_a, n_b)")

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (matrix(batch.column(c), np.uint8, PLACES) for c in ("sketch_a", "sketch_b"))
            agreeing = (a == b).sum(axis=1)
            found = pa.record_batch(
                {"a": batch.column("a"), "b": batch.column("b"), "agreeing": pa.array(agreeing.astype(np.int32))}
            )
            yield found.filter(pa.array(agreeing >= LEAST_AGREEING))

    return flat.drop("n_a", "n_b").mapInArrow(weigh, "a long, b long, agreeing int").distinct()


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are similar by their full sets."""
    first = sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
    second = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column("of_a"), batch.column("of_b")):
                x, y = np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U)
                both = np.sort(np.concatenate([x, y]), kind="stable")
                same = int((both[1:] == both[:-1]).sum())
                linked.append(100 * same >= PERCENT * (len(x) + len(y) - same))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    joined = pairs.select("a", "b").join(first, "a").join(second, "b")
    return joined.mapInArrow(compare, "a long, b long").distinct()


def first_picks(candidates: DataFrame) -> DataFrame:
    """A few candidates of each node: the likeliest on either side of it, and the smallest."""
    likely = F.max(F.struct("agreeing", "a", "b")).alias("best")
    picks = candidates.groupBy("b").agg(likely, F.min("a").alias("least"))
    by_a = candidates.groupBy("a").agg(likely)
    return (
        picks.select("best.a", "best.b")
        .union(picks.select(F.col("least").alias("a"), "b"))
        .union(by_a.select("best.a", "best.b"))
        .distinct()
    )


def divided(rows: DataFrame) -> DataFrame:
    """Each row in two parts of its region, so that any two whose sizes are a step apart or less share one.

    Parts by other places of the signature would lose pairs that agree in the region's alone. Parts of groups
    by rare shingles stay below 0."""
    step = F.floor(F.log(F.col("n").cast("double")) / math.log(SIZE_STEP)).cast("int")
    parts = F.when(F.col("part") < 0, F.array(-2 - step, -3 - step)).otherwise(F.array(step, step + 1))
    return rows.withColumn("part", F.explode(parts))


def weighed(rows: DataFrame, path: str) -> DataFrame:
    """The rows of those parts of regions that have pairs across components: all pairs less those within
    each. With the part's `size`, its pairs `across`, the label of its largest component, `top`, and `n_top`
    rows of that."""
    labels = rows.groupBy("key", "part", "label").agg(F.count("*").alias("c"))
    squares = (F.sum("c") * F.sum("c") - F.sum(F.col("c") * F.col("c"))) / 2
    parts = labels.groupBy("key", "part").agg(
        F.sum("c").alias("size"), squares.alias("across"), F.max(F.struct("c", "label")).alias("most")
    )
    parts = parts.where("across > 0").select(
        "key", "part", "size", "across", F.col("most.label").alias("top"), F.col("most.c").alias("n_top")
    )
    return stored(rows.join(parts, ["key", "part"]), path)


def slot_ranks(sets: DataFrame) -> np.ndarray:
    """How common the shingles of each of 2^18 slots are: the logarithm of their number, in quarters, as a byte.
    What comes to the driver is a row per slot at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SLOT_BITS, np.int64)
        for batch in batches:
            for x in batch.column("shingles"):
                np.add.at(counts, slots_of(np.frombuffer(x.as_buffer(), U)), 1)
        used = np.flatnonzero(counts)
        yield pa.record_batch({"slot": pa.array(used.astype(np.int32)), "c": pa.array(counts[used])})

    counted = sets.select("shingles").mapInArrow(count, "slot int, c long").groupBy("slot").agg(F.sum("c").alias("c"))
    found = counted.toArrow()
    ranks = np.zeros(1 << SLOT_BITS, np.uint8)
    ranks[found["slot"].to_numpy()] = 1 + 4 * np.log2(found["c"].to_numpy())
    return ranks


def slots_of(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> U(64 - SLOT_BITS)).astype(np.int64)


def rare_shingles(sets: DataFrame, crowd: DataFrame) -> DataFrame:
    """A row for each node of `crowd` and each of the first n - 0.75 n + 1 shingles of its set, rarest first,
    with the shingle as `key` of a group, -1 as `part`, and how many shingles of the set begin with it, `rest`.

    Of two sets with similarity 0.75 each has at least that share of its shingles in common with the other.
    So the rarest common one is among the first of both, in whatever order, as long as it is the same for all.
    """
    chosen = sets.join(crowd.select("node", "label").hint("shuffle_hash"), "node")
    ranks = slot_ranks(sets.join(crowd.select("node").hint("shuffle_hash"), "node", "left_semi"))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "shingles", BATCH_BYTES):
            keys = [np.zeros(0, U)]
            for x in batch.column("shingles"):
                shingles = np.frombuffer(x.as_buffer(), U)
                first = len(shingles) - -(-PERCENT * len(shingles) // 100) + 1
                keys.append(shingles[np.argsort(ranks[slots_of(shingles)], kind="stable")[:first]])
            count = np.array([len(k) for k in keys[1:]])
            of, first = np.repeat(np.arange(len(count)), count), np.repeat(np.cumsum(count) - count, count)
            # Rows that share a doc_id can have sets of other sizes than their node's.
            n = pa.compute.binary_length(batch.column("shingles")).to_numpy().astype(np.int64)[of] // 8
            yield pa.record_batch(
                {
                    "key": pa.array(np.concatenate(keys).view(np.int64)),
                    "part": pa.array(np.full(len(of), -1, np.int32)),
                    "node": batch.column("node").take(pa.array(of)),
                    "n": pa.array(n),
                    "label": batch.column("label").take(pa.array(of)),
                    "rest": pa.array(n - (np.arange(len(of)) - first)),
                }
            )

    return chosen.mapInArrow(pick, "key long, part int, node long, n long, label long, rest long").distinct()


def within_reach(rows: DataFrame) -> DataFrame:
    """The rows of `rare_shingles` that can belong to a similar pair whose rarest common shingle is their key.

    Such a pair has no more in common than the `rest` of either, which has to be 3/7 of both sizes. For the
    smaller set that is 6/7 of its own, so a group without such a row has no pair, and the smallest of these rows
    tells what the others need.
    """
    needed, given = F.lit(PERCENT), F.col("rest") * (100 + PERCENT)
    smallest = rows.where(given >= needed * 2 * F.col("n")).groupBy("key").agg(F.min("n").alias("smallest"))
    reached = rows.join(smallest, "key").where(given >= needed * (F.col("n") + F.col("smallest")))
    return reached.drop("rest", "smallest")


def all_keys(nodes: DataFrame) -> DataFrame:
    """`node` and `keys`, those of its regions in all trees."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = matrix(batch.column("signature"), np.uint32, PLACES).astype(U).reshape(-1, TREES, DEPTH)
            keys = [k.tobytes() for k in region_keys(places)]
            yield pa.record_batch({"node": batch.column("node"), "keys": pa.array(keys, pa.binary())})

    return nodes.select("node", "signature").mapInArrow(gather, "node long, keys binary")


def bit_sketches(sets: DataFrame) -> DataFrame:
    """`node` and `bits`, one bit of each of 4096 min-hashes."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(21)
        factor, add = rng.integers(0, 1 << 32, (2, BITS), dtype=np.uint64).astype(np.uint32)
        factor |= np.uint32(1)
        for batch in batches:
            out = []
            for x in batch.column("shingles"):
                short = (np.frombuffer(x.as_buffer(), U) >> U(32)).astype(np.uint32)
                least = np.full(BITS, 0xFFFFFFFF, np.uint32)
                for at in range(0, len(short), 256):
                    np.minimum(least, (short[at : at + 256, None] * factor + add).min(axis=0), out=least)
                out.append(np.packbits((least >> np.uint32(9)) & np.uint32(1)).tobytes())
            yield pa.record_batch({"node": batch.column("node"), "bits": pa.array(out, pa.binary())})

    return sets.mapInArrow(build, "node long, bits binary")


def dealt(rows: DataFrame) -> DataFrame:
    """Rows dealt to pairs of blocks, `low` and `high`, with their `own` block.

    Of a pair across components one at least is outside the largest. So blocks of those rows meet each other
    and all blocks of the rest, which do not meet among themselves. A part of one block meets itself.
    """
    alone, minor = F.col("size") <= BLOCK_NODES, F.col("label") != F.col("top")
    minors = F.when(alone, 1).otherwise(F.ceil((F.col("size") - F.col("n_top")) / BLOCK_NODES)).cast("int")
    majors = F.when(alone, 0).otherwise(F.ceil(F.col("n_top") / BLOCK_NODES)).cast("int")
    place = F.xxhash64("node")
    own = F.when(alone, 0).when(minor, F.pmod(place, minors)).otherwise(minors + F.pmod(place, majors)).cast("int")
    last = F.when(minor & ~alone, minors + majors - 1).otherwise(minors - 1)
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    low, high = F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")
    return rows.select("key", "part", low, high, "own", "node", "n", "bits", "keys", "label", "top")


def compared(rows: DataFrame) -> DataFrame:
    """Pairs of rows of a region that are in different components and alike by their signatures, found by
    comparing two blocks in place. `rows` are weighed."""

    def compare(table: pa.Table) -> pa.Table:
        node, n, label = (table[c].to_numpy() for c in ("node", "n", "label"))
        keys, region = matrix(table["keys"].combine_chunks(), np.int64, TREES), table["key"][0].as_py()
        bits = matrix(table["bits"].combine_chunks(), U, BITS // 64)
        own, low, high = table["own"].to_numpy(), table["low"][0].as_py(), table["high"][0].as_py()
        by_region = table["part"][0].as_py() >= 0
        outside = label != table["top"].to_numpy()
        minor, here = np.flatnonzero((own == low) & outside), np.flatnonzero(own == high)
        words = np.ascontiguousarray(bits[here].T)
        found = []
        for at in range(0, len(minor), 256):
            x = minor[at : at + 256]
            differing = np.zeros((len(x), len(here)), np.uint16)
            for w in range(len(words)):
                differing += np.bitwise_count(bits[x, w][:, None] ^ words[w])
            least, most = np.minimum(n[x][:, None], n[here]), np.maximum(n[x][:, None], n[here])
            fit = (differing <= MOST_DIFFERING) & (label[x][:, None] != label[here]) & (100 * least >= PERCENT * most)
            if low == high:
                fit &= ~outside[here] | (x[:, None] < here)
            i, j = np.nonzero(fit)
            x, y = x[i], here[j]
            if by_region:
                # A pair is told by the first region that it shares.
                told = keys[x, (keys[x] == keys[y]).argmax(axis=1)] == region
                x, y = x[told], y[told]
            found.append(np.stack([node[x], node[y]]))
        a, b = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    pairs = dealt(rows).groupBy("key", "part", "low", "high")
    return pairs.applyInArrow(compare, "a long, b long").distinct()


def between_components(
    regions: DataFrame, nodes: DataFrame, labels: DataFrame, sets: DataFrame, folder: str
) -> DataFrame:
    """Candidate pairs of larger regions whose nodes are in different components so far. In the most crowded
    ones, those of nodes that share a rare shingle."""
    rows = regions.where(F.col("size") > SMALL_REGION).select("key", F.lit(0).alias("part"), "node", "n")
    rows = rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    rows = weighed(rows, f"{folder}/rows")
    few = F.col("across") <= CROWD_PAIRS * F.col("size")
    crowd = rows.where(~few).select("node", "label").distinct()
    if crowd.take(1):
        rare = stored(rare_shingles(sets, stored(crowd, f"{folder}/crowd")), f"{folder}/rare")
        near = stored(within_reach(rare), f"{folder}/near")
        rows = rows.where(few).unionByName(weighed(near, f"{folder}/sharing"))
    # Sets of rows that share a doc_id can have one node; all of them are compared.
    fine = bit_sketches(sets.join(rows.select("node").distinct(), "node", "left_semi"))
    rows = rows.join(fine.distinct(), "node").join(all_keys(nodes), "node")
    rows = stored(rows, f"{folder}/fine")
    few = F.col("across") <= PAIRS_PER_NODE * F.col("size")
    found = stored(compared(rows.where(few)), f"{folder}/across")
    many = rows.where(~few).drop("size", "across", "top", "n_top")
    if not many.take(1):
        return found
    more = compared(weighed(divided(many), f"{folder}/parts"))
    return found.union(stored(more, f"{folder}/across-parts")).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """`doc_id`, `n_shingles`, `component_id` and `kept` for every row of `docs`.

    Documents are linked if their sets of 5-word shingles (words of any characters but white
    space, A-Z lower-cased) have a similarity of 0.75 or more; a component is named by its smallest
    doc_id, and that document is kept.

    Null or empty text, or white space only: no shingles, linked with nothing, kept. Null doc_id:
    such a row cannot name a component; it is linked with nothing, has no component_id and is
    kept. Repeated rows get the same answer each; rows that share a doc_id but not their text are
    one document, linked with what either is. Other columns are not looked at.
    """
    spark = docs.sparkSession
    folder = work_folder(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    every = stored(sketches(docs), f"{folder}/sketches")
    members = every.where("doc_id is not null and n_shingles > 0")
    # One node per distinct set, named by its smallest document.
    whole = F.min(F.struct("doc_id", "n_shingles", "signature")).alias("first")
    nodes = members.groupBy("key_a", "key_b").agg(whole).select(
        "key_a", "key_b", F.col("first.doc_id").alias("node"), F.col("first.n_shingles").alias("n"), "first.signature"
    )
    nodes = stored(nodes, f"{folder}/nodes")
    regions = stored(with_sketch(crowded(forest(nodes.select("node", "signature"))), nodes), f"{folder}/regions")
    candidates = stored(alike(neighbours(regions)), f"{folder}/candidates")
    sets = stored(sets_of(docs, regions.select("node").distinct()), f"{folder}/sets")

    picked = stored(first_picks(candidates), f"{folder}/picked")
    shared = between_rows(members.select("doc_id", "key_a", "key_b"), nodes)
    links = stored(confirmed(picked, sets).union(shared), f"{folder}/links")
    labels = stored(components(links, folder), f"{folder}/labels")

    def label(side: str) -> DataFrame:
        return labels.select(F.col("node").alias(side), F.col("label").alias(f"label_{side}"))

    rest = candidates.select("a", "b").union(between_components(regions, nodes, labels, sets, folder)).distinct()
    rest = rest.join(label("a"), "a", "left").join(label("b"), "b", "left")
    rest = rest.where("coalesce(label_a, a) != coalesce(label_b, b)").join(picked, ["a", "b"], "left_anti")
    more = confirmed(rest, sets).join(label("a"), "a", "left").join(label("b"), "b", "left")
    more = more.selectExpr("coalesce(label_a, a) as a", "coalesce(label_b, b) as b")
    joined = components(more, folder).select(F.col("node").alias("label"), F.col("label").alias("final"))
    labels = labels.union(more_nodes(joined, labels)).join(joined, "label", "left")
    labels = labels.select("node", F.coalesce("final", "label").alias("component_id"))

    named = nodes.select("key_a", "key_b", "node").join(labels, "node", "left")
    named = named.select("key_a", "key_b", F.coalesce("component_id", "node").alias("component_id"))
    out = every.drop("signature").join(named, ["key_a", "key_b"], "left")
    linked = F.col("n_shingles") > 0
    component = F.when(F.col("doc_id").isNotNull() & linked, F.col("component_id")).otherwise(F.col("doc_id"))
    out = out.select("doc_id", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def between_rows(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links (a, b) between the nodes of rows that share a doc_id but not their set."""
    ends = [f(k) for k in ("key_a", "key_b") for f in (F.min, F.max)]
    ends = [c.alias(n) for c, n in zip(ends, ("a0", "a1", "b0", "b1"))]
    several = members.groupBy("doc_id").agg(*ends).where("a0 != a1 or b0 != b1").select("doc_id")
    rows = members.join(several.hint("shuffle_hash"), "doc_id", "left_semi").distinct()
    rows = rows.join(nodes.select("key_a", "key_b", "node"), ["key_a", "key_b"])
    least = rows.groupBy("doc_id").agg(F.min("node").alias("a"))
    return rows.join(least, "doc_id").where("a != node").select("a", F.col("node").alias("b")).distinct()


def more_nodes(joined: DataFrame, labels: DataFrame) -> DataFrame:
    """Nodes that were alone before the second round, labelled by themselves."""
    alone = joined.select(F.col("label").alias("node")).join(labels.select("node"), "node", "left_anti")
    return alone.select("node", F.col("node").alias("label"))


def with_sketch(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Rows of the forest with the node's size and a byte of each place of its signature."""

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low = matrix(batch.column("signature"), np.uint32, PLACES).astype(np.uint8)
            yield pa.record_batch(
                {
                    "node": batch.column("node"),
                    "n": batch.column("n"),
                    "sketch": pa.array([x.tobytes() for x in low], pa.binary()),
                }
            )

    short = nodes.select("node", "n", "signature").mapInArrow(shorten, "node long, n long, sketch binary")
    return rows.join(short, "node")


def sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """`node` and its full set, for the nodes wanted."""
    # With many documents those wanted are too many to broadcast.
    wanted = wanted.withColumnRenamed("node", "doc_id").hint("shuffle_hash")
    chosen = docs.join(wanted, "doc_id", "left_semi")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            sets = shingle_sets(flat_texts(batch.column("text")))
            yield pa.record_batch(
                {"node": batch.column("doc_id"), "shingles": pa.array([s.tobytes() for s in sets], pa.binary())}
            )

    return chosen.mapInArrow(build, "node long, shingles binary")

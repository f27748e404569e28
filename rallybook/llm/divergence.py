"""Operator 11: how the words of each source diverge from its language, by dominance skybands.

Words are counted in tasks, exactly, on whole texts, and summed per (lang, source, word) by Spark. A
source's ten most telling words need not be ranked over all its words: the value of a word only
grows with its count in the source and only falls with its count in the language, so a word
that at least ten others dominate (count in the source not lower, count in the language not
higher, earlier by UTF-8) is never among the ten. Each partition keeps its own skyband, the words
with fewer than ten such others; skybands are merged source by source, and what is left is ranked.

Sources are compared pairwise with sums over all words of the language. Few words occur in both
sources, so what a pair would sum if no word occurred is corrected by words that occur in
one of them, through a histogram of counts, and by words that occur in both, through a join.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rallybook.llm.text import LOWER, flat_texts, slices, split_words
from rallybook.sources.scratch import stored, work_folder

FEWEST_DOCS = 10
TOP = 10
SCALE = 1_000_000_000
PIECE_BYTES = 8 << 20

# Everything in ASCII that is no letter.
NO_LETTERS = np.zeros(256, bool)
NO_LETTERS[[*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True


def piece_counts(batch: pa.RecordBatch) -> pa.RecordBatch:
    """`group` (of the batch's rows), `term`, `n` and `docs` for the texts of a batch, exact."""
    texts = flat_texts(batch.column("text"))
    texts.buf = LOWER[texts.buf]
    words = split_words(texts, NO_LETTERS)
    lengths = words.end - words.start
    inside = ~NO_LETTERS[texts.buf[: texts.start[-1]]]
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    body = texts.buf[: texts.start[-1]][inside]
    buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(body)]
    coded = pa.Array.from_buffers(pa.large_binary(), len(lengths), buffers).dictionary_encode()
    terms, code = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    per_row = np.diff(words.of)
    # Words of a document first, as a word's documents are counted too.
    key, n = np.unique(np.repeat(np.arange(len(per_row)), per_row) * max(len(terms), 1) + code, return_counts=True)
    row, code = np.divmod(key, max(len(terms), 1))
    group = batch.column("group").to_numpy(zero_copy_only=False)[row]
    pair, place = np.unique(group * max(len(terms), 1) + code, return_inverse=True)
    group, code = np.divmod(pair, max(len(terms), 1))
    total = np.bincount(place, n, len(pair)).astype(np.int64)
    docs = np.bincount(place, minlength=len(pair)).astype(np.int64)
    return pa.record_batch(
        {
            "group": pa.array(group),
            "term": terms.take(pa.array(code)).cast(pa.binary()),
            "n": pa.array(total),
            "docs": pa.array(docs),
        }
    )


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in slices(batches, "text", PIECE_BYTES):
        names = pa.StructArray.from_arrays([piece.column("lang"), piece.column("source")], ["lang", "source"])
        places: dict = {}
        group = [places.setdefault((x["lang"], x["source"]), len(places)) for x in names.to_pylist()]
        counted = piece_counts(pa.record_batch({"text": piece.column("text"), "group": pa.array(group, pa.int64())}))
        of = counted.column("group").to_numpy(zero_copy_only=False)
        known = list(places)
        yield pa.record_batch(
            {
                "lang": pa.array([k[0] for k in known], pa.string()).take(pa.array(of)),
                "source": pa.array([k[1] for k in known], pa.string()).take(pa.array(of)),
                "term": counted.column("term"),
                "n": counted.column("n"),
                "docs": counted.column("docs"),
            }
        )


def word_counts(docs: DataFrame) -> DataFrame:
    """`lang`, `source`, `term` (UTF-8), `n` occurrences and `docs`, the documents that have it."""
    schema = "lang string, source string, term binary, n long, docs long"
    counted = docs.select("lang", "source", F.col("text").cast("binary").alias("text")).mapInArrow(count_words, schema)
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


class Skyband:
    """The words of one group that fewer than `most` earlier ones dominate. Words come by count in the
    group, falling, then by count in the language, rising, then by UTF-8.

    `steps` are the counts in the language that kept words have; beside each stand the `most`
    earliest words kept at it or below. Both only shrink, so a word is looked up by one bisection.
    """

    def __init__(self, most: int):
        self.most, self.steps, self.earliest = most, [], []

    def keeps(self, in_lang: int, term: bytes) -> bool:
        at = bisect_right(self.steps, in_lang)
        best = self.earliest[at - 1] if at else []
        if len(best) == self.most and best[-1] < term:
            return False
        if not at or self.steps[at - 1] != in_lang:
            self.steps.insert(at, in_lang)
            self.earliest.insert(at, list(best))
            at += 1
        for words in self.earliest[at - 1 :]:
            if len(words) == self.most and words[-1] < term:
                break  # and so are all further on
            place = bisect_right(words, term)
            words.insert(place, term)
            del words[self.most :]
        return True


def skyband(rows: DataFrame, most: int) -> DataFrame:
    """Per (lang, source), of the words that share a partition, those that fewer than `most` others
    dominate. Rows stream by in order; only a skyband is held."""

    def band(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, Skyband(most)
        for batch in batches:
            keep = []
            names = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())
            for name, in_lang, term in zip(names, batch.column("in_lang").to_pylist(), batch.column("term").to_pylist()):
                if name != group:
                    group, held = name, Skyband(most)
                keep.append(held.keeps(in_lang, term))
            yield batch.filter(pa.array(keep, pa.bool_()))

    order = ["lang", "source", F.col("n").desc(), F.col("in_lang"), F.col("term")]
    return rows.sortWithinPartitions(*order).mapInArrow(band, rows.schema)


def smoothed(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * kept)), in decimals, as the product may not fit into 64
    bits. Without kept words no use is made of it."""
    over = (count + 2).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.lit(1).cast("long") + F.call_function("div", over, F.greatest(total + 2 * kept, F.lit(1)).cast("decimal(20,0)"))


def spread(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)) of two bigints up to about 10^9."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def kept_words(docs: DataFrame, folder: str, fewest_docs: int) -> DataFrame:
    """The words that their language keeps: `lang`, `source`, `term`, `n`, and `in_lang`, the
    occurrences in the language; a stored table."""
    counts = stored(word_counts(docs), f"{folder}/counts")
    in_lang = counts.groupBy("lang", "term").agg(F.sum("n").alias("in_lang"), F.sum("docs").alias("docs"))
    in_lang = in_lang.where(F.col("docs") >= fewest_docs).drop("docs")
    return stored(counts.drop("docs").join(in_lang, ["lang", "term"]), f"{folder}/kept")


def group_totals(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Every (lang, source) that occurs, with `total`, its occurrences of kept words, `vocabulary`,
    how many words its language keeps, and `lang_total`, their occurrences there."""
    groups = docs.select("lang", "source").distinct()
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    words = kept.groupBy("lang", "term").agg(F.sum("n").alias("n"))
    whole = words.groupBy("lang").agg(F.count("*").alias("vocabulary"), F.sum("n").alias("lang_total"))
    return groups.join(own, ["lang", "source"], "left").join(whole, "lang", "left").fillna(0)


def telling_words(kept: DataFrame, totals: DataFrame, folder: str, top: int) -> DataFrame:
    """The `top` words of each group that are more frequent in it than in its language."""
    local = stored(skyband(kept.repartition("lang", "term"), top), f"{folder}/skybands")
    merged = skyband(local.repartition("lang", "source"), top)
    rows = merged.join(totals, ["lang", "source"]).select(
        "lang",
        "source",
        F.lit("term").alias("part"),
        F.col("term").cast("string").alias("item"),
        smoothed(F.col("n"), F.col("total"), F.col("vocabulary")).alias("p"),
        smoothed(F.col("in_lang"), F.col("lang_total"), F.col("vocabulary")).alias("q"),
    )
    rows = rows.where("p > q").withColumn("value", spread(F.col("p"), F.col("q"))).drop("p", "q")
    return ranked(rows).where(F.col("rank") <= top)


def ranked(rows: DataFrame) -> DataFrame:
    order = "row_number() over (partition by lang, source, part order by value desc, item)"
    return rows.withColumn("rank", F.expr(order))


def source_distances(kept: DataFrame, totals: DataFrame) -> DataFrame:
    """`lang`, `source`, `item` (another source of the language) and `value`, both ways round."""
    groups = totals.withColumn("zero", smoothed(F.lit(0).cast("long"), F.col("total"), F.col("vocabulary")))
    groups = groups.select("lang", "source", "total", "vocabulary", "zero")
    a, b = groups.alias("a"), groups.alias("b")
    zeros = spread(F.col("a.zero"), F.col("b.zero"))
    same, other = F.col("a.lang") == F.col("b.lang"), F.col("a.source") != F.col("b.source")
    names = [F.col("a.lang").alias("lang"), F.col("a.source").alias("source"), F.col("b.source").alias("item")]
    parts = [a.join(b, same & other).select(*names, (F.col("a.vocabulary") * zeros).alias("value"))]

    words = kept.join(groups, ["lang", "source"])
    p = smoothed(F.col("n"), F.col("total"), F.col("vocabulary"))
    words = words.select("lang", "source", "term", p.alias("p"), "zero")
    # Words of one source against none in the other: equal counts give equal figures.
    alike = words.groupBy("lang", "source", "p").agg(F.count("*").alias("words"), F.first("zero").alias("zero"))
    one = alike.alias("a").join(b, same & other)
    extra = F.col("a.words") * (spread(F.col("a.p"), F.col("b.zero")) - zeros)
    one = one.select(*names, extra.alias("value")).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    parts += [one, one.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")]

    # Words of both, each pair of sources once.
    both = words.alias("a").join(words.alias("b"), same & (F.col("a.term") == F.col("b.term")) & (F.col("a.source") < F.col("b.source")))
    met = (
        spread(F.col("a.p"), F.col("b.p"))
        - spread(F.col("a.p"), F.col("b.zero"))
        - spread(F.col("a.zero"), F.col("b.p"))
        + zeros
    )
    both = both.select(*names, met.alias("value")).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    parts += [both, both.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")]
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    return table.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def divergence(docs: DataFrame, fewest_docs: int = FEWEST_DOCS, top: int = TOP) -> DataFrame:
    """`lang`, `source`, `part`, `item`, `value` and `rank`: per source all other sources of its language
    (part `pair`) and the words it is told by (part `term`, up to `top`).

    Null text, lang and source are empty strings. Each row is a document, rows that share an id
    or everything too; ids are not read. Ties rank by the item's UTF-8. A source without kept words
    has `pair` rows only, the only source of a language has no rows. An empty table gives an empty
    result. Other columns are not looked at. A text may be as long as a task can hold.
    """
    folder = work_folder(docs.sparkSession)
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    kept = kept_words(docs, folder, fewest_docs)
    totals = stored(group_totals(docs, kept), f"{folder}/groups")
    pairs = source_distances(kept, totals).withColumn("part", F.lit("pair"))
    terms = telling_words(kept, totals, folder, top)
    return ranked(pairs).unionByName(terms).select("lang", "source", "part", "item", "value", "rank")

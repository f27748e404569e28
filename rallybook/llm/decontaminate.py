"""Operator 7: benchmark passages in documents, by winnowing.

DataFrame functions only. A text's fingerprints are the smallest hash of six neighbouring
5-word grams, for every ten words in a row, so two texts that share ten words share the fingerprint
of those ten. Documents and benchmark items meet on distinct fingerprints; where they do, the hit is
extended: the ten words around a fingerprint that matched are compared as words. An item of fewer
than ten words has no such window and is looked up whole among all grams of its length.

Rows that meet carry a hash of the text instead of the text, and copies of a text count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rallybook.sources.scratch import stored, work_folder

WINDOW = 10
GRAM = 5
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Runs of digits, letters and characters beyond ASCII, A-Z in lower case."""
    ascii_only = F.length(text) == F.octet_length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(F.coalesce(lowered, F.lit("")), SEPARATORS), "")


def grams(hashes: str, n: int) -> Column:
    """A hash of every `n` neighbouring elements of a column. It is looked into by the function of each
    element, so it has to be a column and not an expression, which each would compute anew."""

    def gram(x, i):
        return F.xxhash64(x, *[F.get(hashes, i + j) for j in range(1, n)])

    return F.slice(F.transform(hashes, gram), F.lit(1), F.greatest(F.size(hashes) - (n - 1), F.lit(0)))


def hashed(df: DataFrame) -> DataFrame:
    """Adds to `words` their hashes `h`, and `prints`, the smallest gram hash of every `WINDOW` words,
    by the first of them."""
    span = WINDOW - GRAM

    def least(x, i):
        return F.least(x, *[F.get("g", i + j) for j in range(1, span + 1)])

    df = df.withColumn("h", F.transform("words", lambda w: F.xxhash64(w))).withColumn("g", grams("h", GRAM))
    count = F.greatest(F.size("g") - span, F.lit(0))
    return df.withColumn("prints", F.slice(F.transform("g", least), F.lit(1), count)).drop("g")


def windows(n: Column) -> Column:
    """Every `n` words in a row as one string, by the first of them."""
    starts = F.when(F.size("words") >= n, F.sequence(F.lit(0), F.size("words") - n)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.concat_ws(" ", F.slice("words", i + 1, n)))


def places_of(prints: str, marks: str, steps: str) -> Column:
    """Where the prints of a text are among its marks, which are sorted, by binary search: `steps` are the
    powers of two below the number of marks, falling. All three have to be columns of a table."""

    def last_not_above(x):
        def further(at, step):
            return F.when(F.get(marks, at + step) <= x, at + step).otherwise(at)

        return F.get(marks, F.aggregate(steps, F.lit(0), further))

    return F.filter(
        F.transform(prints, lambda x, i: F.when(last_not_above(x) == x, i)), lambda i: i.isNotNull()
    )


def items_of(benchmark: DataFrame) -> DataFrame:
    """`item`, `words`, `h` and the length `m` of the windows of each item."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("words"))
    items = items.where(F.size("words") > 0).withColumn("m", F.least(F.size("words"), F.lit(WINDOW)))
    return hashed(items)


def occurrences(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All rows of `docs` (doc_id, key of the text, n_words), and where distinct texts hold a
    window of an item: `key`, `at` (first word), `m` words, `item`, null for items without an id."""
    folder = work_folder(docs.sparkSession)
    items = stored(items_of(benchmark), f"{folder}/items")
    short = [r.m for r in items.select("m").distinct().collect() if r.m < WINDOW]
    text = docs.select("doc_id", "text", F.md5("text").alias("key"))
    split = hashed(text.select("doc_id", "key", words(F.col("text")).alias("words")))
    marks = {0: F.array_distinct("prints")}
    for m in short:
        marks[m] = F.array_distinct(grams("h", m))
    columns = [m_column.alias(f"mark_{m}") for m, m_column in marks.items()]
    sized = stored(split.select("doc_id", "key", F.size("words").cast("long").alias("n_words"), *columns), f"{folder}/marks")
    met = None
    for m in marks:
        of_items = items.where(F.col("m") == (m or WINDOW))
        probe = F.col("prints") if m == 0 else grams("h", m)
        of_items = of_items.select(F.explode(probe).alias("mark")).distinct()
        of_docs = sized.where("key is not null").select("key", F.explode(f"mark_{m}").alias("mark"))
        pairs = of_docs.join(of_items, "mark").select("key", F.lit(m or WINDOW).alias("m"), "mark")
        met = pairs if met is None else met.union(pairs)
    # A text has no more marks than words.
    met = met.distinct().groupBy("key", "m").agg(F.sort_array(F.collect_list("mark")).alias("marks"))
    bits = F.ceil(F.log2(F.size("marks").cast("double"))).cast("int")
    powers = F.transform(F.sequence(bits - 1, F.lit(0)), lambda i: F.pow(F.lit(2), i).cast("int"))
    steps = F.when(bits > 0, powers).otherwise(F.array().cast("array<int>"))
    met = stored(met.withColumn("steps", steps), f"{folder}/met")
    # Texts that met are too many to broadcast as soon as there are many documents.
    some = met.select("key").distinct().hint("shuffle_hash")
    texts = text.join(some, "key", "left_semi").select("key", "text").dropDuplicates(["key"])
    texts = hashed(texts.select("key", words(F.col("text")).alias("words"))).join(met, "key")
    own = F.when(F.col("m") == WINDOW, F.col("prints"))
    for m in short:
        own = own.when(F.col("m") == m, grams("h", m))
    texts = texts.withColumn("own", own)
    texts = texts.withColumn("near", places_of("own", "marks", "steps"))
    found = texts.select("key", "m", "words", F.explode("near").alias("at"))
    found = found.select("key", "m", "at", F.concat_ws(" ", F.slice("words", F.col("at") + 1, F.col("m"))).alias("window"))
    wanted = items.select("item", "m", F.explode(windows(F.col("m"))).alias("window")).distinct()
    hits = found.join(wanted, ["m", "window"]).select("key", "at", "m", "item")
    return sized.select("doc_id", "key", "n_words"), stored(hits, f"{folder}/hits")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """`doc_id`, `n_words`, `n_hit` (words inside an occurrence of a window), `items` (their
    ids as strings, sorted) and `contaminated` for every row of `docs`.

    A window is ten consecutive words of an item, or a shorter item whole. Null or empty texts and
    items without words have none. An item without an id makes hits but is not among `items`; items that share an
    id are one. Documents: repeated rows and null ids get an answer each. Empty tables: no rows, or
    no hits. Other columns are not looked at.
    """
    rows, hits = occurrences(docs, benchmark)
    inside = hits.select("key", F.explode(F.sequence("at", F.col("at") + F.col("m") - 1)).alias("word"))
    counts = inside.distinct().groupBy("key").agg(F.count("*").alias("n_hit"))
    named = hits.groupBy("key").agg(F.sort_array(F.collect_set("item")).alias("items"))
    found = counts.join(named, "key")
    out = rows.join(found, "key", "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), items.alias("items"), (n_hit > 0).alias("contaminated"))

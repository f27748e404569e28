"""Operator 10: quality rules and robust multivariate outliers.

DataFrame functions only. A document has four plain statistics besides its number of words. Their
transformed values form a vector. For each language and source, the location and scatter of the bulk
of the vectors are estimated by minimum covariance determinant: from medians and absolute deviations
as a start, concentration steps take the 75 % of the documents that are nearest by Mahalanobis
distance and estimate anew from these, which never increases the determinant. A document too far from
its group's bulk is rejected, unless it fails a base rule already. The same is done for whole languages and
for all documents, and a group too small for an estimate of its own is judged by its language's,
or by that of all.

The vectors are held in whole 1/4096, and sums of them and of their products are exact, so
estimates do not depend on the order of rows. Quantiles are taken over counts per narrow
bin. Every step is a group-by that reduces before it shuffles, and only the small table of
vectors is read again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from rallybook.sources.scratch import stored, work_folder

SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]"
LEAST_WORDS = 50
MOST_REPEATED = 50
UNIT = 4096
COVERAGE = 0.75
STEPS = 4
DIMENSIONS = ("words", "length", "symbols", "lines", "repeats")
# Fixed values for five dimensions: the 75 % quantile of chi-square, the factor that makes the
# scatter of the nearest 75 % of normal vectors that of all, and the 0.99999 quantile.
START_QUANTILE = 6.6257
CONSISTENCY = 1.3779
CUTOFF = 30.856
# Standard deviations below which a statistic is not told apart, in units of its dimension.
FLOORS = {"words": 0.3, "length": 0.35, "symbols": 0.05, "lines": 0.08, "repeats": 0.08}
# Documents that an estimate of a source, and of a language, has to rest on.
FEWEST = 20
# Levels of groups: a source of a language, a language, everything.
SOURCE, LANGUAGE, ALL = 0, 1, 2
GROUP = ["level", "lang", "source"]
# Beyond so many characters a word, documents are equally far away.
LONGEST = 1000.0


def statistics(docs: DataFrame) -> DataFrame:
    """`n_words`, `word_chars`, `n_symbols`, `n_dup_lines` and `n_repeat_words` of each text."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.withColumns(
        {
            "_words": F.array_remove(F.split(text, SPACE), ""),
            "_lines": F.filter(F.split(text, "\n"), lambda x: x.rlike(NOT_SPACE)),
            "n_symbols": F.regexp_count(text, F.lit(SYMBOL)).cast("long"),
        }
    )
    rows = rows.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_hashes": F.transform("_words", lambda w: F.xxhash64(w)),
        }
    ).drop("_words", "_lines", "text")
    # A window's hash above its place, in one number: equal windows are neighbours when sorted. A
    # text of n words has 64 - log2(n) bits of hash.
    low = F.greatest(F.ceil(F.log2(F.size("_hashes") + 1.0)), F.lit(1)).cast("int")
    rows = rows.withColumn("_low", low)

    def pack(x, i):
        h = F.xxhash64(x, F.get("_hashes", i + 1), F.get("_hashes", i + 2))
        return F.call_function("shiftleft", hash_of(h), F.col("_low")).bitwiseOR(i.cast("long"))

    def hash_of(x):
        return F.call_function("shiftright", x, F.col("_low"))

    count = F.greatest(F.size("_hashes") - 2, F.lit(0))
    rows = rows.withColumn("_packed", F.sort_array(F.slice(F.transform("_hashes", pack), F.lit(1), count)))

    def repeated(x, i):
        before = F.coalesce(hash_of(F.get("_packed", i - 1)) == hash_of(x), F.lit(False))
        return before | F.coalesce(hash_of(F.get("_packed", i + 1)) == hash_of(x), F.lit(False))

    mask = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_low")) - 1
    places = F.transform(F.filter("_packed", repeated), lambda x: x.bitwiseAND(mask))
    rows = rows.withColumn("_places", F.sort_array(places)).drop("_hashes", "_packed", "_low")
    # Windows of three words: each adds the words up to the next window, three at most.
    gaps = F.transform("_places", lambda p, i: F.least(F.coalesce(F.get("_places", i + 1) - p, F.lit(3)), F.lit(3)))
    return rows.withColumn("n_repeat_words", F.aggregate(gaps, F.lit(0).cast("long"), lambda s, g: s + g)).drop("_places")


def vectors(df: DataFrame) -> DataFrame:
    """The transformed statistics, in whole units. Rates per word are skewed to the right, so their
    square roots are taken. All are bounded, so that products of two fit into 64 bits."""
    n = F.greatest("n_words", F.lit(1))
    lines = F.col("n_dup_lines") / F.greatest(F.col("n_dup_lines") + 10, F.lit(1))
    values = {
        "words": F.log1p("n_words"),
        "length": F.least(F.col("word_chars") / n, F.lit(LONGEST)),
        "symbols": F.sqrt(F.least(F.col("n_symbols") / n, F.lit(4.0))),
        "lines": lines,
        "repeats": F.sqrt(F.col("n_repeat_words") / n),
    }
    return df.withColumns({d: F.round(v / FLOORS[d] * UNIT).cast("long") for d, v in values.items()})


def distance(estimate: str = "e") -> Column:
    """Squared Mahalanobis distance to the group's estimate, by forward substitution with the
    Cholesky factor of its scatter, kept as columns `l_i_j` beside the means `m_i`."""
    solved: list[Column] = []
    for i, d in enumerate(DIMENSIONS):
        value = F.col(d) / UNIT - F.col(f"{estimate}.m_{i}")
        for j in range(i):
            value = value - F.col(f"{estimate}.l_{i}_{j}") * solved[j]
        solved.append(value / F.col(f"{estimate}.l_{i}_{i}"))
    return sum((s * s for s in solved[1:]), solved[0] * solved[0])


def estimated(rows: DataFrame, factor: float) -> DataFrame:
    """Mean and Cholesky factor of the scatter of each group, floors added to the diagonal."""
    exact = "decimal(38,0)"
    sums = [F.count("*").alias("c")]
    for i, a in enumerate(DIMENSIONS):
        sums.append(F.sum(F.col(a).cast(exact)).cast("double").alias(f"s_{i}"))
        for j in range(i + 1):
            sums.append(F.sum((F.col(a) * F.col(DIMENSIONS[j])).cast(exact)).cast("double").alias(f"s_{i}_{j}"))
    out = rows.groupBy(*GROUP).agg(*sums)
    size = len(DIMENSIONS)
    out = out.withColumns({f"m_{i}": F.col(f"s_{i}") / F.col("c") / UNIT for i in range(size)})
    for i in range(size):
        for j in range(i + 1):
            value = (F.col(f"s_{i}_{j}") / F.col("c") / UNIT / UNIT - F.col(f"m_{i}") * F.col(f"m_{j}")) * factor
            if i == j:
                value = value + 1.0
            for k in range(j):
                value = value - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            value = F.sqrt(F.greatest(value, F.lit(1e-6))) if i == j else value / F.col(f"l_{j}_{j}")
            out = out.withColumn(f"l_{i}_{j}", value)
    kept = [f"m_{i}" for i in range(size)] + [f"l_{i}_{j}" for i in range(size) for j in range(i + 1)]
    return out.select(*GROUP, F.struct(*kept).alias("e"))


def at_quantile(rows: DataFrame, bins: str, share: float) -> DataFrame:
    """The bin of each group below or in which `share` of its rows lie."""
    counts = rows.groupBy(*GROUP, bins).agg(F.count("*").alias("c"))
    group = Window.partitionBy(*GROUP)
    below = F.sum("c").over(group.orderBy(bins))
    reached = counts.withColumn("reached", below >= F.sum("c").over(group) * share)
    return reached.where("reached").groupBy(*GROUP).agg(F.min(bins).alias("limit"))


def with_group(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """Rows with what is known of their group; a null language or source is a group of its own."""
    named = estimates.withColumnsRenamed({c: f"_{c}" for c in GROUP})
    return rows.join(named, same_group(), "left").drop(*[f"_{c}" for c in GROUP])


def same_group() -> Column:
    return reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in GROUP])


def in_groups(rows: DataFrame, *columns) -> DataFrame:
    """Each row once in its source, its language, and everything, with the given columns."""
    none = F.lit(None).cast("string")
    keys = [(SOURCE, F.col("lang"), F.col("source")), (LANGUAGE, F.col("lang"), none), (ALL, none, none)]
    groups = [F.struct(F.lit(a).alias("level"), b.alias("lang"), c.alias("source")) for a, b, c in keys]
    rows = rows.select(F.explode(F.array(*groups)).alias("g"), F.struct(*columns).alias("rest"))
    return rows.select("g.*", "rest.*")


def finest(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """For each source of `rows`, the estimate of the finest of its groups that is large enough; if only
    everything is left, that one however small it is."""
    enough = estimates.where((F.col("level") == ALL) | (F.col("members") >= FEWEST)).drop("members")
    sources = in_groups(rows.select("lang", "source").distinct(), F.struct("lang", "source").alias("of"))
    met = with_group(sources, enough).where(F.col("e").isNotNull())
    best = met.groupBy("of").agg(F.min_by("e", "level").alias("e"))
    return best.select(F.lit(SOURCE).alias("level"), "of.*", "e")


def start(rows: DataFrame) -> DataFrame:
    """Medians, and 1.4826 times the median absolute deviations, as a first estimate."""
    size = range(len(DIMENSIONS))
    # One row per group, dimension and value bin: counts, not documents, are ordered.
    long = rows.select(*GROUP, F.explode(F.array(*[F.struct(F.lit(i).alias("d"), F.floor(F.col(x) / (UNIT // 16)).alias("v")) for i, x in enumerate(DIMENSIONS)])).alias("x"))
    counts = long.groupBy(*GROUP, "x.d", "x.v").agg(F.count("*").alias("c"))

    def median(table: DataFrame, value: str, name: str) -> DataFrame:
        group = Window.partitionBy(*GROUP, "d")
        reached = F.sum("c").over(group.orderBy(value)) * 2 >= F.sum("c").over(group)
        found = table.withColumn("reached", reached).where("reached")
        return found.groupBy(*GROUP, "d").agg(F.min(value).alias(name))

    medians = median(counts, "v", "m").withColumnsRenamed({c: f"_{c}" for c in [*GROUP, "d"]})
    apart = counts.join(medians, same_group() & (F.col("d") == F.col("_d"))).drop(*[f"_{c}" for c in GROUP]).withColumn("apart", F.abs(F.col("v") - F.col("m")))
    spread = apart.groupBy(*GROUP, "d", "apart", "m").agg(F.sum("c").alias("c"))
    group = Window.partitionBy(*GROUP, "d")
    reached = F.sum("c").over(group.orderBy("apart")) * 2 >= F.sum("c").over(group)
    found = spread.withColumn("reached", reached).where("reached")
    found = found.groupBy(*GROUP, "d", "m").agg(F.min("apart").alias("a"))
    columns = []
    for i in size:
        here = F.col("d") == i
        columns.append(F.max(F.when(here, (F.col("m") + 0.5) / 16)).alias(f"m_{i}"))
    for i in size:
        for j in range(i + 1):
            deviation = F.max(F.when(F.col("d") == i, F.col("a") / 16 * 1.4826))
            columns.append((F.sqrt(deviation * deviation + 1.0) if i == j else F.lit(0.0)).alias(f"l_{i}_{j}"))
    names = [f"m_{i}" for i in size] + [f"l_{i}_{j}" for i in size for j in range(i + 1)]
    return found.groupBy(*GROUP).agg(*columns).select(*GROUP, F.struct(*names).alias("e"))


def judged(docs: DataFrame) -> DataFrame:
    """`doc_id`, `lang`, `source`, the statistics, `base_failed`, `distance` (squared, robust) and
    `kept` for every row of `docs`.

    A document fails the base rules with fewer than 50 words or more than half of its words in
    repeated 3-word windows. The estimates are made from those that do not fail. A source with fewer
    than `FEWEST` such is judged by its language's estimate, and a language with fewer by that of all
    documents, however few they are; without any, no distance is known. Null text: no words. Null language or source: a
    group of their own. Repeated rows count as often as they occur; null ids get an answer. An
    empty table gives an empty result. Other columns are not looked at.
    """
    folder = work_folder(docs.sparkSession)
    rows = statistics(docs.select("doc_id", "text", "lang", "source"))
    repeated = 100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    rows = rows.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | repeated)
    rows = stored(vectors(rows), f"{folder}/vectors")
    good = in_groups(rows.where("not base_failed"), *DIMENSIONS)
    sizes = good.groupBy(*GROUP).agg(F.count("*").alias("members"))
    estimate = stored(start(good), f"{folder}/estimate-0")
    for step in range(STEPS):
        # Bins of one 64th of an octave.
        near = with_group(good, estimate).withColumn("bin", F.floor(F.log2(distance() + 2.0**-10) * 64))
        limits = at_quantile(near, "bin", COVERAGE)
        inner = with_group(near.drop("e"), limits).where("bin <= limit")
        estimate = stored(estimated(inner, CONSISTENCY), f"{folder}/estimate-{step + 1}")
    known = stored(finest(rows, with_group(estimate, sizes)), f"{folder}/known")
    out = with_group(rows.withColumn("level", F.lit(SOURCE)), known).withColumn("distance", distance())
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= CUTOFF, F.lit(True))
    return out.withColumn("kept", kept).drop("e", "level", *DIMENSIONS)

"""The corpus pipeline: from raw documents to a weighted mix.

Each stage takes (spark, docs, sf_dir) and works on all rows of `docs`, the documents that its
predecessor kept. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rallybook.llm import decontaminate, exact_dedup, mixing, near_dedup, toxicity
from rallybook.llm.columns import unused
from rallybook.sources.scratch import stored, work_folder


def renamed_for(docs: DataFrame, *names: str) -> tuple[DataFrame, dict[str, str]]:
    """The documents with columns that an operator adds under other names, and how to name them back."""
    back = {}
    for name in names:
        if name in docs.columns and name not in ("doc_id", "text"):
            free = unused(name, [*docs.columns, *names])
            docs, back[free] = docs.withColumnRenamed(name, free), name
    return docs, back


def drop_toxic(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model scores below its threshold. It learns from the labelled
    documents among them that are not held out; without any, all stay.

    Null and empty texts have the score of the model's bias alone. Repeated rows and rows without an id are
    judged each; equal texts are judged alike. An empty table stays empty. All columns are kept, whatever
    their names.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~toxicity.held_out())
    model = toxicity.trained(docs, labels)
    rows, back = renamed_for(docs, "score")
    kept = toxicity.scored(rows, model).where(F.col("score") < toxicity.THRESHOLD)
    return kept.drop("score").withColumnsRenamed(back).select(*docs.columns)


def drop_near_duplicates(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates, the one with the smallest doc_id. Documents
    without an id, and those that are linked with nothing, stay. Of identical rows with an id one stays.

    Null and empty texts are linked with nothing. An empty table stays empty. All columns are kept.
    """
    groups = stored(near_dedup.near_duplicates(docs), f"{work_folder(spark)}/groups")
    gone = groups.where("not kept").select("doc_id").distinct()
    named = docs.where("doc_id is not null").join(gone.hint("shuffle_hash"), "doc_id", "left_anti")
    # Rows lie by doc_id already, so no second shuffle is needed.
    one = named.select(*docs.columns).distinct()
    return one.union(docs.where("doc_id is null"))


def cut_repeats(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that smaller documents have; whole characters are cut. Documents
    of which nothing is left stay as empty texts, and a null text becomes empty.

    `n_chars`, if there, counts what is left. Repeated rows are cut alike. An empty table stays empty. All
    other columns are kept, whatever their names.
    """
    rows, back = renamed_for(docs, "n_bytes", "n_removed", "spans", "kept")
    cut = exact_dedup.repeated_passages(rows, whole_characters=True)
    cut = cut.withColumn("text", F.col("kept").cast("string"))
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut.drop("n_bytes", "n_removed", "spans", "kept").withColumnsRenamed(back).select(*docs.columns)


def drop_contaminated(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark, whether its items have an id or not.

    They are judged by their text, so documents without an id are too. Null and empty texts hold no
    passage. Repeated rows are judged alike. Empty tables: nothing to judge, or nothing goes. All columns are
    kept, whatever their names.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    _, hits = decontaminate.occurrences(docs, benchmark)
    key = unused("key", docs.columns)
    gone = hits.select(F.col("key").alias(key)).distinct().hint("shuffle_hash")
    return docs.withColumn(key, F.md5("text")).join(gone, key, "left_anti").select(*docs.columns)


def mix(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes.

    Null and empty texts have size 0 and nothing is taken of them. Repeated rows and rows without an id are
    taken each. An empty table gives an empty mix.
    """
    return mixing.mixed(docs).select("doc_id", "source", "size", "source_size", "target", "taken")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("mixing", mix),
]
# The first stage is a trained model, which SQL does not express.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    """All stages on the documents; what one returns is written and read again for the next."""
    folder = work_folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

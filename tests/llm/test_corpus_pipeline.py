import random

import corpus_pipeline as P
from rallybook.llm import toxicity


def test_stages_act_and_keep_clean_documents(spark, tmp_path):
    rng = random.Random(12)

    def prose(n):
        return " ".join(f"é{rng.randrange(100000)}" for _ in range(n))

    clean = {i: prose(rng.randrange(20, 200)) for i in range(300)}
    toxic = {1000 + i: prose(30) + " vile scum" for i in range(60)}
    passage, item = prose(40), " ".join(f"w{rng.randrange(100000)}" for _ in range(15))
    near = {2000 + i: " ".join([*clean[5].split()[:-1], "other"]) for i in range(3)}
    repeated = {3000: prose(50) + " " + passage, 3001: prose(50) + " " + passage}
    leaked = {4000: prose(50) + " " + item.upper() + " " + prose(20)}
    texts = clean | toxic | near | repeated | leaked
    rows = [(d, t, "en", f"src{d % 4}", len(t)) for d, t in texts.items()] + [(None, None, None, None, None)]
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, columns).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(d, int(d in toxic)) for d in [*clean, *toxic]]
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {}
    for n, (name, stage) in enumerate(P.STAGES[:-1]):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        out.write.parquet(f"{tmp_path}/out/{n}")
        docs = spark.read.schema(out.schema).parquet(f"{tmp_path}/out/{n}")
        kept[name] = {r.doc_id: r for r in docs.collect()}
    held = {r.doc_id for r in spark.createDataFrame([(d,) for d in toxic], "doc_id long").where(toxicity.held_out()).collect()}
    assert set(texts) - set(kept["toxicity"]) <= set(toxic) and not (set(toxic) - held) & set(kept["toxicity"])
    assert set(kept["toxicity"]) - set(kept["near_dedup"]) == set(near)
    assert set(kept["suffix_dedup"]) == set(kept["near_dedup"])
    assert passage in kept["suffix_dedup"][3000].text and passage not in kept["suffix_dedup"][3001].text
    assert kept["suffix_dedup"][3001].n_chars == len(kept["suffix_dedup"][3001].text)
    assert all(kept["suffix_dedup"][d].text == clean[d] for d in clean)
    assert set(kept["suffix_dedup"]) - set(kept["decontamination"]) == {4000}
    mixed = P.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in mixed} == set(kept["decontamination"]) and None in kept["decontamination"]
    for source in {r.source for r in mixed}:
        own = [r for r in mixed if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 0.5


def test_benchmark_items_without_an_id_count(spark, tmp_path):
    item, short = " ".join(f"w{i}" for i in range(15)), "three odd words"
    benchmark = spark.createDataFrame([(None, item), (None, short), (1, "z " * 12)], "item_id long, text string")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    texts = [(1, f"a b {item} c"), (2, f"a {short} b"), (3, "z " * 12), (4, "clean"), (None, item), (5, None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    kept = P.drop_contaminated(spark, docs, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in kept) == [4, 5]


CLASHES = ("score", "_key", "key", "n_bytes", "n_removed", "spans", "kept", "component_id", "rest", "body", "block", "hash")


def stage_tables(spark, path, texts):
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(d, t, "en", "s", len(t or "")) for d, t in texts]
    docs = spark.createDataFrame(rows, columns)
    for i, name in enumerate(CLASHES):
        docs = docs.withColumn(name, P.F.concat(P.F.lit(f"{i}-"), P.F.coalesce(P.F.col("doc_id"), P.F.lit(0))))
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(2, 0), (5, 0)], "doc_id long, toxic int").write.parquet(f"{path}/labels.parquet")
    item = "one two three four five six seven eight nine ten"
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return spark.read.parquet(f"{path}/documents.parquet")


def test_stages_keep_columns_of_any_name(spark, tmp_path):
    """Also with null, empty and very long texts, repeated rows, and rows without an id."""
    rng = random.Random(3)
    long = " ".join(f"w{rng.randrange(10**6)}" for _ in range(150_000))
    texts = [(1, "bad words"), (2, "clean words"), (3, None), (4, ""), (5, long), (6, "x" * 1_000_000),
             (7, "same text here"), (7, "same text here"), (None, "nobody"), (None, None)]
    docs = stage_tables(spark, tmp_path, texts)
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.dtypes == docs.dtypes, name
        rows = out.collect()
        for r in rows:
            assert [r[c] for c in CLASHES] == [f"{i}-{r.doc_id or 0}" for i in range(len(CLASHES))], name
            assert r.n_chars == len(r.text or "")
        found = {r.doc_id: r.text for r in rows}
        assert set(found) >= {2, 3, 4, 5, 6, 7, None} and found[5] == long, name
        assert sum(r.doc_id is None for r in rows) == 2
        assert sum(r.doc_id == 7 for r in rows) == (1 if name == "near_dedup" else 2), name


def test_an_empty_pipeline(spark, tmp_path):
    docs = stage_tables(spark, tmp_path, [])
    for name, stage in P.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).collect() == [], name
    assert P.run(spark, str(tmp_path)).collect() == []


def test_stages_after_the_model_equal_plain_rules(spark, tmp_path):
    """Near-duplicates, passages, benchmark and mix on the same documents, each from what the one before kept,
    against their SQL in DuckDB, where a stage has one."""
    import duckdb

    from rallybook.llm.oracle import ORACLE_SQL

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    duck = duckdb.connect()
    duck.execute(f"create view benchmark as select * from '{sf}/benchmark.parquet'")
    duck.execute("create table documents as select * from read_parquet(?)", [f"{sf}/documents.parquet"])

    def step(stage, sql):
        """The stage's rows, and the ids and texts that the SQL leaves of the same input."""
        out = stage(spark, docs, sf)
        out.write.parquet(f"{tmp_path}/{stage.__name__}")
        return spark.read.parquet(f"{tmp_path}/{stage.__name__}"), dict(duck.execute(sql).fetchall())

    near, expected = step(P.drop_near_duplicates, f"select doc_id, text from documents join ({ORACLE_SQL['op2_near_dedup']}) x using (doc_id) where kept")
    assert {r.doc_id: r.text for r in near.collect()} == expected
    docs = near
    leaks, expected = step(P.drop_contaminated, f"select doc_id, text from documents join ({ORACLE_SQL['op7_decontamination']}) x using (doc_id) where not contaminated")
    kept = {r.doc_id for r in near.collect()}
    assert {r.doc_id: r.text for r in leaks.collect()} == {d: t for d, t in expected.items() if d in kept}
    duck.execute("create or replace table documents as select * from read_parquet(?)", [f"{tmp_path}/drop_contaminated/*.parquet"])
    docs = leaks
    mixed = {r.doc_id: (r.size, r.source_size, r.target, r.taken) for r in P.mix(spark, docs, sf).collect()}
    rows = duck.execute(f"select doc_id, size, source_size, target, taken from ({ORACLE_SQL['op4_mixing']}) x").fetchall()
    assert mixed == {r[0]: r[1:] for r in rows}

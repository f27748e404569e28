import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import GroupedData, functions as F

import corpus_pipeline
from rallybook.llm import near_dedup
from rallybook.llm.graph import components
from rallybook.llm.near_dedup import near_duplicates


def shingle_set(text):
    text = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} - {()})


def brute_force(rows):
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    where = defaultdict(list)
    for i, s in enumerate(sets):
        if rows[i][0] is None:
            continue
        common = Counter(j for g in s for j in where[g])
        for g in s:
            where[g].append(i)
        for j, k in common.items():
            if 100 * k >= 75 * (len(s) + len(sets[j]) - k):
                parent[find(i)] = find(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[find(i)].append(d)
    out = []
    for i, (d, _) in enumerate(rows):
        c = None if d is None else min(least[find(i)])
        out.append((d, len(sets[i]), c, d is None or c == d))
    return Counter(out)


def edited(rng, words, share):
    return [rng.choice("abcdefgh") * 3 + str(rng.random()) if rng.random() < share else w for w in words]


def corpus(rng, groups, copies):
    rows = []
    for g in range(groups):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(5, 300))]
        for c in range(copies):
            rows.append(" ".join(edited(rng, base, rng.choice([0, 0.01, 0.02, 0.05]))))
    return rows


def test_groups_copies_and_odd_texts(spark):
    rng = random.Random(11)
    texts = corpus(rng, 30, 4)
    texts += [None, "", "  \n", "a b c", "A B\tC", "a b c d", "x " * 50, "x " * 500, "Ä b c d e f", "ä b c d e f"]
    rows = [(i * 3, t) for i, t in enumerate(texts)] + [(None, texts[0]), (5, texts[1]), (5, texts[1])]
    rng.shuffle(rows)
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").withColumn("label", F.lit(1)))
    assert Counter(tuple(r) for r in got.collect()) == brute_force(rows)


def test_crowded_regions_and_weak_links(spark, monkeypatch):
    """Many relatives of one text, few of them similar enough, with every region compared in blocks and
    the larger ones divided."""
    monkeypatch.setattr(near_dedup, "SMALL_REGION", 2)
    monkeypatch.setattr(near_dedup, "BLOCK_NODES", 16)
    monkeypatch.setattr(near_dedup, "PAIRS_PER_NODE", 20)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(200)]
    texts = [" ".join(edited(rng, base, rng.choice([0.005, 0.01, 0.03, 0.05]))) for _ in range(150)]
    rows = list(enumerate(texts))
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert Counter(tuple(r) for r in got.collect()) == brute_force(rows)


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components_of_chains_rings_and_stars(spark, tmp_path):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 230)] + [(1, 2), (2, 3), (3, 1), (9, 9)]
    random.Random(1).shuffle(edges)
    found = components(spark.createDataFrame(edges, "a long, b long"), str(tmp_path))
    labels = {r.node: r.label for r in found.collect()}
    assert labels == {**{i: 100 for i in range(100, 161)}, **{i: 7 for i in range(200, 230)}, 7: 7, 1: 1, 2: 1, 3: 1}


def test_no_task_holds_a_crowded_region(spark, monkeypatch):
    """A page template with other words on every page: regions of hundreds of nodes, nearly all in
    components of their own, and pairs that only the comparison of blocks finds."""
    monkeypatch.setattr(near_dedup, "SMALL_REGION", 2)
    monkeypatch.setattr(near_dedup, "BLOCK_NODES", 64)
    monkeypatch.setattr(near_dedup, "PAIRS_PER_NODE", 20)
    sizes, apply = [], GroupedData.applyInArrow

    def watched(self, function, schema):
        sizes.append(self.count().agg(F.max("count")).first()[0] or 0)
        return apply(self, function, schema)

    monkeypatch.setattr(GroupedData, "applyInArrow", watched)
    rng = random.Random(8)
    template = [f"t{i}" for i in range(150)]
    texts = [" ".join(template + [f"u{rng.randrange(10**9)}" for _ in range(60)]) for _ in range(500)]
    for i in range(0, 40, 2):
        words = texts[i].split()
        texts[i + 1] = " ".join(words[:150] + edited(rng, words[150:], 0.05))
    rows = list(enumerate(texts))
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert Counter(tuple(r) for r in got.collect()) == brute_force(rows)
    # Blocks are dealt by hash, so they vary a little.
    assert 64 < max(sizes) <= 2 * 64 * 1.4


@pytest.mark.parametrize("shared, size_step", [(150, 20), (165, 20), (190, 20), (190, 2048)])
def test_crowds_meet_by_rare_shingles(spark, monkeypatch, shared, size_step):
    """Pages of one template, whose own words are more than a quarter of them, so that no rare shingle is
    shared, or fewer, so that the template's are among the rarest. Long and short pages, and weak links."""
    monkeypatch.setattr(near_dedup, "SMALL_REGION", 2)
    monkeypatch.setattr(near_dedup, "BLOCK_NODES", 64)
    monkeypatch.setattr(near_dedup, "PAIRS_PER_NODE", size_step)
    monkeypatch.setattr(near_dedup, "CROWD_PAIRS", 1)
    groups, rare = [], near_dedup.rare_shingles

    def watched(sets, crowd):
        groups.append(crowd.count())
        return rare(sets, crowd)

    monkeypatch.setattr(near_dedup, "rare_shingles", watched)
    rng = random.Random(shared)
    template = [f"t{i}" for i in range(shared)]
    texts = [" ".join(template + [f"u{rng.randrange(10**9)}" for _ in range(210 - shared)]) for _ in range(200)]
    texts += [" ".join(template[:-5] + [f"v{rng.randrange(10**9)}" for _ in range(90)]) for _ in range(50)]
    for i in range(0, 120, 2):
        words = texts[i].split()
        texts[i + 1] = " ".join(edited(rng, words, rng.choice([0.01, 0.02, 0.03, 0.04])))
    texts += texts[:5]
    rows = list(enumerate(texts)) + [(7, "other text " * 9), (None, texts[0])]
    rng.shuffle(rows)
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert Counter(tuple(r) for r in got.collect()) == brute_force(rows)
    assert groups and groups[0] > 100


def test_the_first_quarter_of_rarest_shingles_meets_all_similar_sets(spark):
    """Also for sets of one to five shingles, and where slots are shared by many."""
    rng = random.Random(3)
    sets = []
    for i in range(300):
        base = rng.sample(range(40), rng.choice([1, 2, 3, 4, 5, 8, 13, 20]))
        sets.append((i, len(base), i, np.sort(np.array(base, np.uint64) << np.uint64(rng.choice([40, 57]))).tobytes()))
    frame = spark.createDataFrame(sets, "node long, n long, label long, shingles binary")
    rare = near_dedup.rare_shingles(frame.select("node", "shingles"), frame.select("node", "label"))
    rows = near_dedup.within_reach(rare)
    met = defaultdict(set)
    for r in rows.collect():
        assert r.part == -1 and (r.n, r.label) == (sets[r.node][1], r.node)
        met[r.key].add(r.node)
    together = {(a, b) for g in met.values() for a in g for b in g if a < b}
    full = [set(np.frombuffer(s[3], np.uint64).tolist()) for s in sets]
    for a in range(len(full)):
        for b in range(a + 1, len(full)):
            if 100 * len(full[a] & full[b]) >= 75 * len(full[a] | full[b]):
                assert (a, b) in together


def test_rows_that_share_an_id_link_their_texts(spark, tmp_path):
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(5, a), (9, a), (3, b), (5, b), (20, c), (20, c), (None, c), (None, c)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.component_id, r.kept) for r in near_duplicates(docs).collect()}
    assert got == {(5, 3, False), (9, 3, False), (3, 3, True), (20, 20, True), (None, None, True)}
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, str(tmp_path)).collect()
    assert Counter(map(tuple, kept)) == Counter([(3, b), (20, c), (None, c), (None, c)])

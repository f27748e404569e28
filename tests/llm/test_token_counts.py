from collections import Counter

import numpy as np
import pytest

from rallybook.llm.queries import op3_token_counts
from rallybook.llm.token_counts import (
    ID_TOKENS,
    VOCABULARY,
    encoded,
    from_id_tokens,
    separator_scan,
    tokenizer,
    write_token_files,
)


@pytest.mark.parametrize("block", [1, 3, 7, 1000])
def test_separators_at_any_place(spark, tmp_path, block):
    files = {
        "a": [5, 6, 0, 7, 0, 0, 8, 9, 10, 0],
        "b": [0, 0, 1],
        "c": [4] * 9,
        "d": [],
        "e": [0],
        "f": [1, 2, 0, 3],
        "g": [1] * 20 + [0] + [2] * 13 + [0, 3],
    }
    for name, ids in files.items():
        (tmp_path / name).write_bytes(np.array(ids, "<u2").tobytes())
    expected = []
    for name, ids in files.items():
        at = 0
        for i, part in enumerate("".join(chr(x + 65) for x in ids).split("A")):
            if at < len(ids):
                expected.append((name, i, at, len(part), [ord(c) - 65 for c in part + "A" * 9][:1] or []))
            at += len(part) + 1
    got = separator_scan(spark, str(tmp_path), head=1, block_tokens=block).collect()
    rows = sorted((r.file.rsplit("/", 1)[1], r.document, r.start, r.n_tokens, list(r["first"])) for r in got)
    assert [r[:4] for r in rows] == sorted(e[:4] for e in expected)
    assert [r[4] for r in rows] == [e[4] for e in sorted(expected)]


def test_round_trip_of_texts(spark, tmp_path):
    texts = ["Hello, wörld!\n\n  and  more", None, "", "x" * 5000, "日本語 text \u0000 with zero", "same", "same"]
    rows = list(enumerate(texts)) + [(2**62 + 5, "big"), (-7, "negative"), (None, "nobody")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    write_token_files(docs, f"{tmp_path}/tokens")
    got = separator_scan(spark, f"{tmp_path}/tokens", head=ID_TOKENS, block_tokens=16)
    got = got.select(from_id_tokens(got["first"]).alias("doc_id"), "n_tokens")
    encoding = tokenizer(VOCABULARY)
    expected = {d: len(encoding.encode_ordinary(t or "")) for d, t in rows if d is not None}
    assert {r.doc_id: r.n_tokens - ID_TOKENS for r in got.collect()} == expected


@pytest.mark.parametrize("blank", [" ", "\n", " \n", "\u3000\t"])
@pytest.mark.parametrize("before, after", [("a", "b"), ("", "b"), ("a!", ""), ("don't 12", "'s x"), ("", ""), ("a", "\x1cb")])
def test_long_runs_of_blanks_give_the_same_tokens(blank, before, after):
    encoding = tokenizer(VOCABULARY)
    for count in (49_999, 50_000, 60_001):
        run = (blank * count)[:count]
        text = f"{before}{run}{after}{run}{after}"
        assert encoded(encoding, text) == encoding.encode_ordinary(text)


def test_a_run_of_blanks_that_the_pattern_cannot_match(spark, tmp_path):
    """The matcher would panic on these, which ends the task."""
    texts = ["a" + " " * 1_000_000 + "b", "\n" * 2_000_000, "x" * 1_000_000, "word " * 200_000]
    write_token_files(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), f"{tmp_path}/tokens")
    got = {r.n_tokens for r in separator_scan(spark, f"{tmp_path}/tokens").collect()}
    encoding = tokenizer(VOCABULARY)
    lines = len(encoding._encode_single_piece("\n" * 2_000_000))
    assert got == {ID_TOKENS + n for n in (1_000_001, lines, 125_000, 200_001)} and lines < 2_000_000


def test_empty_table(spark, tmp_path):
    write_token_files(spark.createDataFrame([], "doc_id long, text string"), f"{tmp_path}/none")
    assert separator_scan(spark, f"{tmp_path}/none").count() == 0


def test_part_of_a_token_fails(spark, tmp_path):
    (tmp_path / "odd").write_bytes(b"abc")
    with pytest.raises(Exception, match="buffer size"):
        separator_scan(spark, str(tmp_path)).collect()


def test_the_query_counts_rows_without_an_id(spark, tmp_path):
    rows = [(None, "nobody"), (None, None), (0, "zero"), (-1, "all bits"), (2**63 - 1, "most"), (-(2**63), "least")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    encoding = tokenizer(VOCABULARY)
    expected = Counter((d, len(encoding.encode_ordinary(t or ""))) for d, t in rows)
    assert Counter(map(tuple, op3_token_counts(spark, str(tmp_path)).collect())) == expected

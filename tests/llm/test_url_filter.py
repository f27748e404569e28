import datetime

from rallybook.llm.url_filter import filtered

DAY = datetime.date(2024, 1, 1)


def day(n):
    return DAY + datetime.timedelta(n)


def test_entries_hold_on_their_days_only(spark):
    entries = [
        ("example.com", day(10), True),
        ("Example.com", day(400), False),
        ("blog.example.com", day(20), True),
        ("blog.example.com", day(20), False),
        ("blog.example.com", day(21), False),
        ("site.org/en", day(0), True),
        ("back.net", day(5), True),
        ("back.net", day(6), False),
        ("back.net", day(700), True),
        (None, day(0), True),
        ("x.com", None, True),
        ("y.com", day(0), None),
    ]
    captures = [
        (1, "http://a.example.com/x", day(9)),
        (2, "http://a.example.com/x", day(10)),
        (3, "https://u:p@A.EXAMPLE.com:80/x?q", day(399)),
        (4, "http://a.example.com/x", day(400)),
        (5, "http://blog.example.com", day(20)),
        (6, "http://blog.example.com", day(21)),
        (7, "http://site.org/en/page", day(900)),
        (8, "http://site.org/fr/page", day(900)),
        (9, "http://back.net", day(5)),
        (10, "http://back.net", day(300)),
        (11, "http://back.net", day(2000)),
        (12, "not a url", day(50)),
        (13, None, day(50)),
        (14, "http://a.example.com/x", None),
        (15, "http://notexample.com", day(50)),
        (16, "http://x.com", day(50)),
        (None, "http://a.example.com/x", day(10)),
        (2, "http://a.example.com/x", day(10)),
    ]
    rows = filtered(
        spark.createDataFrame(captures, "page_id long, url string, day date").selectExpr("*", "'old' as matched"),
        spark.createDataFrame(entries, "pattern string, day date, listed boolean"),
    ).collect()
    assert len(rows) == len(captures)
    blocked = {(r.page_id, r.n_active, r.matched) for r in rows if r.blocked}
    assert blocked == {
        (2, 1, "example.com"),
        (3, 1, "example.com"),
        (5, 2, "blog.example.com"),
        (6, 1, "example.com"),
        (7, 1, "site.org/en"),
        (9, 1, "back.net"),
        (11, 1, "back.net"),
        (None, 1, "example.com"),
    }
    assert {r.page_id: r.host for r in rows}[3] == "a.example.com" and {r.page_id: r.host for r in rows}[12] is None


def test_intervals_far_beyond_the_captures(spark):
    """They cost no more than the periods of the captures, and columns may have any name."""
    import datetime

    far, old = datetime.date(9999, 12, 31), datetime.date(1, 1, 2)
    entries = [("a.com", old, True), ("b.com", old, True), ("b.com", day(5), False), ("c.com", far, True), ("d.com", day(3), True), ("d.com", far, False)]
    captures = [(i, f"http://x.{c}.com/y", day(n), 1, "u") for c in "abcd" for i, n in enumerate((0, 3, 4, 5, 200))]
    rows = filtered(
        spark.createDataFrame(captures, "page_id long, url string, day date, _url int, _DAY string"),
        spark.createDataFrame(entries, "pattern string, day date, listed boolean"),
    )
    assert rows.columns[:5] == ["page_id", "url", "day", "_url", "_DAY"]
    blocked = {c: sorted(r.page_id for r in rows.collect() if r.blocked and f"x.{c}." in r.url) for c in "abcd"}
    assert blocked == {"a": [0, 1, 2, 3, 4], "b": [0, 1, 2], "c": [], "d": [1, 2, 3, 4]}


def test_a_megabyte_of_url_and_ties(spark):
    entries = [("a.com", day(0), True), ("b.com", day(0), True), ("x.a.com", day(0), True)]
    captures = [(1, "http://x.a.com/" + "p" * 1_000_000, day(1)), (2, "http://" + "l." * 500 + "b.com/", day(1))]
    rows = filtered(
        spark.createDataFrame(captures, "page_id long, url string, day date"),
        spark.createDataFrame(entries, "pattern string, day date, listed boolean"),
    )
    assert {(r.page_id, r.n_active, r.matched) for r in rows.collect()} == {(1, 2, "x.a.com"), (2, 1, "b.com")}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "pattern string, day date, listed boolean")
    captures = spark.createDataFrame([(1, "http://a.b", day(0))], "page_id long, url string, day date")
    assert [r.blocked for r in filtered(captures, none).collect()] == [False]
    assert filtered(captures.limit(0), none).count() == 0

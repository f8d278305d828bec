import datetime as dt

from tidemark.llm import urls

D = dt.date


def test_verdicts_as_of_the_day(frame):
    entries = frame(
        [
            ("Bad.example", "block", D(2024, 1, 10)), ("bad.example", "remove", D(2024, 2, 1)), ("bad.example", "block", D(2024, 3, 1)),
            ("good.bad.example", "allow", D(2024, 1, 1)), ("bad.example/a/b", "allow", D(2024, 1, 1)),
            ("tie.example", "allow", D(2024, 1, 1)), ("tie.example", "block", D(2024, 1, 1)), ("tie.example", "block", D(2024, 1, 1)),
            (None, "block", D(2024, 1, 1)), ("x.example", "block", None), ("x.example", "odd", D(2024, 1, 1)),
        ],
        "key string, verdict string, since date",
    )
    cases = [
        ("http://bad.example/x", D(2024, 1, 9), "none", None), ("http://bad.example/x", D(2024, 1, 10), "block", "bad.example"),
        ("http://bad.example/x", D(2024, 1, 31), "block", "bad.example"), ("http://bad.example/x", D(2024, 2, 1), "none", None),
        ("http://u:p@WWW.Bad.example.:80?q", D(2024, 4, 1), "block", "bad.example"),
        ("https://good.bad.example/", D(2024, 1, 20), "allow", "good.bad.example"),
        ("https://bad.example/a//b/c?x=1", D(2024, 1, 20), "allow", "bad.example/a/b"),
        ("https://bad.example/a", D(2024, 1, 20), "block", "bad.example"), ("https://notbad.example/", D(2024, 1, 20), "none", None),
        ("http://tie.example", D(2024, 5, 1), "block", "tie.example"), ("http://x.example", D(2024, 5, 1), "none", None),
        (None, D(2024, 1, 20), "none", None), ("no url", D(2024, 1, 20), "none", None), ("http://bad.example/", None, "none", None),
        ("http://bad.example/" + "p/" * 3000, D(2024, 1, 20), "block", "bad.example"), ("", D(2024, 1, 20), "none", None),
        ("http://bad.example/x", D(2024, 1, 10), "block", "bad.example"),
    ]
    rows = [(i, u, d, "clash", 1) for i, (u, d, *_) in enumerate(cases)]
    captures = frame(rows, "page_id int, url string, fetched_on date, verdict string, key int")
    got = {r["page_id"]: (r["verdict"], r["matched"]) for r in urls.evaluate(captures, entries).collect()}
    assert got == {i: (v, m) for i, (_, _, v, m) in enumerate(cases)}


def test_empty_tables(frame):
    entries = frame([], "key string, verdict string, since date")
    captures = frame([(1, "http://a.example/", D(2024, 1, 1))], "page_id int, url string, fetched_on date")
    assert [r["verdict"] for r in urls.evaluate(captures, entries).collect()] == ["none"]
    assert urls.evaluate(captures.limit(0), entries).count() == 0


def test_native_plan(frame):
    entries = frame([("a.example", "block", D(2024, 1, 1))], "key string, verdict string, since date")
    captures = frame([(1, "http://a.example/", D(2024, 1, 1))], "page_id int, url string, fetched_on date")
    plan = urls.evaluate(captures, entries)._jdf.queryExecution().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan


def test_paths_keep_their_case(frame):
    entries = frame(
        [("Bad.example/News", "block", D(2024, 1, 1)), ("bad.example/news/A", "allow", D(2024, 1, 1))],
        "key string, verdict string, since date",
    )
    cases = [
        ("http://BAD.example/News/x", "block", "bad.example/News"), ("http://bad.example/news", "none", None),
        ("http://bad.example/news/A/x", "allow", "bad.example/news/A"), ("http://bad.example/news/a", "none", None),
    ]
    captures = frame([(i, u, D(2024, 1, 2)) for i, (u, *_) in enumerate(cases)], "page_id int, url string, fetched_on date")
    got = {r["page_id"]: (r["verdict"], r["matched"]) for r in urls.evaluate(captures, entries).collect()}
    assert got == {i: (v, m) for i, (_, v, m) in enumerate(cases)}


def test_verdicts_at_the_time_of_the_fetch(frame):
    """Entries and captures at times of day: only entries of the same instant are one."""
    t = lambda d, h, m=0: dt.datetime(2024, 1, d, h, m)
    entries = frame(
        [
            ("late.example", "block", t(10, 18)), ("gone.example", "block", t(10, 9)), ("gone.example", "remove", t(10, 10)),
            ("tie.example", "allow", t(10, 9, 30)), ("tie.example", "block", t(10, 9, 30)), ("hour.example", "allow", t(10, 9, 10)),
            ("hour.example", "block", t(10, 9, 20)), ("hour.example", "remove", t(10, 9, 40)),
        ],
        "key string, verdict string, since timestamp_ntz",
    )
    cases = [
        ("late", t(10, 9), "none"), ("late", t(10, 18), "block"), ("late", t(11, 1), "block"), ("gone", t(10, 8, 59), "none"),
        ("gone", t(10, 9), "block"), ("gone", t(10, 9, 59), "block"), ("gone", t(10, 10), "none"), ("gone", t(11, 0), "none"),
        ("tie", t(10, 9, 29), "none"), ("tie", t(10, 9, 30), "block"), ("hour", t(10, 9, 9), "none"), ("hour", t(10, 9, 10), "allow"),
        ("hour", t(10, 9, 19), "allow"), ("hour", t(10, 9, 20), "block"), ("hour", t(10, 9, 39), "block"), ("hour", t(10, 9, 40), "none"),
        ("hour", t(10, 9, 9), "none"), ("hour", None, "none"),
    ]
    rows = [(i, f"http://{name}.example/", at) for i, (name, at, _) in enumerate(cases)]
    captures = frame(rows, "page_id int, url string, fetched_on timestamp_ntz")
    found = urls.evaluate(captures, entries).collect()
    assert {r["page_id"]: r["verdict"] for r in found} == {i: v for i, (*_, v) in enumerate(cases)}
    assert found[0]["since"] is None or isinstance(found[0]["since"], dt.datetime)
    # A list of dates judges captures at times of day from its midnight on.
    dated = frame([("late.example", "block", D(2024, 1, 11))], "key string, verdict string, since date")
    found = {r["page_id"]: r["verdict"] for r in urls.evaluate(captures, dated).collect()}
    assert (found[1], found[2]) == ("none", "block")

import datetime
import random

from pyspark.sql import functions as F

from revlens.llm import url_filter as U
from revlens.llm.queries import ORACLES, QUERIES

E = "kind string, key string, action string, at date"
C = "page_id long, url string, fetched_at date"


def day(n):
    return datetime.date(2024, 1, 1) + datetime.timedelta(n)


def test_intervals_follow_the_entries_in_time(spark):
    rnd = random.Random(3)
    entries = [(rnd.choice(["host", "domain"]), rnd.choice("abc"), rnd.choice(["add", "remove"]), day(rnd.randint(0, 30))) for _ in range(200)]
    spans = [tuple(r) for r in U.intervals(spark.createDataFrame(entries, E)).collect()]
    for kind in ("host", "domain"):
        for key in "abc":
            for n in range(-1, 33):
                past = [(at, a) for k, y, a, at in entries if (k, y) == (kind, key) and at <= day(n)]
                state = max(past)[1] == "add" if past else False  # at one time 'remove' wins
                inside = [s for s in spans if s[:2] == (kind, key) and s[2] <= day(n) and (s[3] is None or day(n) < s[3])]
                assert len(inside) == int(state)


def test_captures_meet_the_entries_of_their_fetch_day(spark):
    entries = spark.createDataFrame([("domain", "bad.org", "add", day(5)), ("domain", "bad.org", "remove", day(9)),
                                     ("host", "www.bad.org", "add", day(7)), ("prefix", "ok.org/ads", "add", day(1))], E)
    urls = ["http://WWW.bad.org/x", "https://bad.org:80/", "https://u:p@www.bad.org./a?b#c", "http://notbad.org/", "http://ok.org/ads/1.html",
            "http://ok.org/adsx", "no url", None, ""]
    rows = [(i, u, day(n)) for i, u in enumerate(urls) for n in (0, 5, 8, 9)] + [(90, urls[0], None), (91, urls[0], day(8)), (91, urls[0], day(8))]
    caps = spark.createDataFrame(rows, C).withColumns({c: F.lit(1) for c in ("kind", "key", "id", "t")})
    got = {(r.page_id, r.fetched_at): r for r in U.as_of(caps, entries).collect()}
    assert len(got) == len(rows) - 1
    listed = {k: (r.listed_kind, r.n_active) for k, r in got.items() if r.listed}
    want = {}
    for i in (0, 2):
        want |= {(i, day(5)): ("domain", 1), (i, day(8)): ("host", 2), (i, day(9)): ("host", 1)}
    want |= {(1, day(5)): ("domain", 1), (1, day(8)): ("domain", 1), (91, day(8)): ("host", 2)}
    want |= {(4, day(n)): ("prefix", 1) for n in (5, 8, 9)}
    assert listed == want and got[91, day(8)].n_rows == 2
    assert got[0, day(8)].listed_since == day(7)


def test_empty_tables(spark):
    none = spark.createDataFrame([], E)
    assert U.as_of(spark.createDataFrame([], C), none).collect() == []
    caps = spark.createDataFrame([(1, "http://a.org/" + "p/" * 3000, day(1))], C)
    assert [r.listed for r in U.as_of(caps, none).collect()] == [False]
    broken = spark.createDataFrame([(None, "a.org", "add", day(0)), ("host", None, "add", day(0)), ("host", "a.org", None, day(0)),
                                    ("host", "a.org", "add", None)], E)
    assert [r.n_active for r in U.as_of(caps, broken).collect()] == [0]


def test_query_equals_its_sql(spark, sf_small):
    from oracle_harness import compare
    r = compare(spark, QUERIES["op9_url_filter"], ORACLES["op9_url_filter"], sf_small)
    assert r["hash_match"] and r["cols_match"], r

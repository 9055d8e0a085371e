from datetime import date

from tallyframe.llm.queries import op9_temporal_url_filter, oracle_sql
from tallyframe.llm.url_filter import temporal_filter

CAPTURE, EVENT = "page_id long, url string, fetched date", "list string, kind string, pattern string, action string, at date"
D = lambda n: date(2024, 1, n)


def rows(found):
    return sorted(map(repr, map(tuple, found)))


def test_matches_sql(spark, oracle, data):
    found = op9_temporal_url_filter(spark, data)
    cursor = oracle.execute(oracle_sql()["op9_temporal_url_filter"])
    assert found.columns == [c[0] for c in cursor.description]
    found = found.collect()
    assert 0 < sum(r["blocked"] for r in found) < len(found)
    assert rows(found) == rows(cursor.fetchall())


def test_intervals_and_specificity(spark):
    events = [("l", "block", "x.com", "add", D(5)), ("l", "block", "x.com", "remove", D(10)), ("l", "block", "x.com", "add", D(20)), ("m", "allow", "x.com/ok", "add", D(1)), ("m", "block", "a.x.com", "add", D(7)),
              ("l", "block", "y.com", "remove", D(3)), ("l", "block", "y.com", "add", D(3)), ("k", "allow", "y.com", "add", D(4)), ("l", None, None, "add", D(1)), ("l", "block", "z.com", "add", None), ("l", "block", "Case.com", "add", D(1)), ("l", "block", "case.COM", "remove", D(3))]
    urls = [(1, "http://x.com/", D(4)), (2, "http://X.com:80/a", D(5)), (3, "http://u:p@x.com?q", D(9)), (4, "http://x.com", D(10)), (5, "https://b.x.com/OK", D(20)), (6, "https://x.com/ok/1", D(20)), (7, "https://x.com/okay", D(20)),
            (8, "http://a.x.com", D(8)), (9, "http://y.com", D(3)), (10, "http://y.com", D(4)), (11, None, D(4)), (12, "no url", D(4)), (13, "http://x.com", None), (14, "http://z.com", D(9)), (None, "http://x.com/", D(6)),
            (15, "http://x.com/" + "p/" * 5000, D(6)), (16, "http://notx.com/", D(6)), (2, "http://X.com:80/a", D(5)), (17, "http://case.com/", D(2)), (18, "http://case.com/", D(4))]
    captures = spark.createDataFrame(urls, CAPTURE).selectExpr("*", "'q' as list", "'r' as pattern")
    found = temporal_filter(captures, spark.createDataFrame(events, EVENT)).collect()
    assert len(found) == len(urls)
    blocked = sorted(-1 if r["page_id"] is None else r["page_id"] for r in found if r["blocked"])
    assert blocked == [-1, 2, 2, 3, 5, 7, 8, 9, 15, 17]
    assert {r["page_id"]: r["pattern"] for r in found}[6] == "x.com/ok"


def test_empty_tables(spark):
    none, event = spark.createDataFrame([], CAPTURE), spark.createDataFrame([], EVENT)
    assert temporal_filter(none, event).count() == 0
    assert [r["blocked"] for r in temporal_filter(spark.createDataFrame([(1, "http://x.com", D(1))], CAPTURE), event).collect()] == [False]

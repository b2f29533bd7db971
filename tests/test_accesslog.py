"""Parser unit table (edge lines) and one-pass vs per-group equivalence."""

from pyspark.sql import functions as F

from tidepool.functions import accesslog as al

GOOD = '10.0.0.1 - u1 [01/Jan/2024:00:00:07 +0000] "GET /a HTTP/1.1" 200 12 "-" "agent-1"'

# (line, matched, ip, loose url, strict url, status, agent)
CASES = [
    (GOOD, True, "10.0.0.1", "/a", "/a", 200, "agent-1"),
    (GOOD.replace("10.0.0.1", "", 1), True, None, "/a", "/a", 200, "agent-1"),
    ("junk " + GOOD, False, "error", "error", "[error]", 0, "error"),
    (GOOD.replace('"GET /a HTTP/1.1"', '""'), True, "10.0.0.1", "[error]", "[error]", 200, "agent-1"),
    (GOOD.replace('"GET /a HTTP/1.1"', '"GET"'), True, "10.0.0.1", "[error]", "[error]", 200, "agent-1"),
    (GOOD.replace('"GET /a HTTP/1.1"', '"GET /a"'), True, "10.0.0.1", "/a", "[error]", 200, "agent-1"),
    (GOOD.replace('"GET /a HTTP/1.1"', '"GET /a b HTTP/1.1"'), True, "10.0.0.1", "/a", "[error]", 200,
     "agent-1"),
    (GOOD.replace('"GET /a HTTP/1.1"', '"GET /a"b HTTP/1.1"'), True, "10.0.0.1", '/a"b', '/a"b', 200,
     "agent-1"),
    (GOOD.replace('"agent-1"', '"agent "quoted" x"'), True, "10.0.0.1", "/a", "/a", 200,
     'agent "quoted" x'),
    (GOOD + "\n", False, "error", "error", "[error]", 0, "error"),
    (GOOD.replace(" 200 ", " abc "), False, "error", "error", "[error]", 0, "error"),
    (GOOD.replace('"GET /a HTTP/1.1"', '"GET /a\u0000 HTTP/1.1"'), True, "10.0.0.1", "/a\u0000",
     "/a\u0000", 200, "agent-1"),
]


def test_edge_lines(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "id int, line string")
    rows = al.to_rows(df, "line", keep=("id",)).orderBy("id").collect()
    strict = al.to_strict_urls(df, "line", keep=("id",)).orderBy("id").collect()
    parsed = al.parse_log(df, "line").orderBy("id").collect()
    for case, r, s, p in zip(CASES, rows, strict, parsed):
        line, matched, ip, loose, strict_url, status, agent = case
        assert p["log"]["matched"] is matched, line
        assert r["ip"] == ip, line
        assert r["url"] == loose, line
        assert s["url"] == strict_url, line
        assert r["status"] == status, line
        assert r["user_agent"] == agent, line


def test_leak_label(spark):
    df = spark.createDataFrame([(GOOD.replace('"GET /a HTTP/1.1"', '"GET"'),), ("junk",)], "line string")
    got = [r["url"] for r in al.to_strict_urls(df, "line", bad_request_label=al.LEAK_LABEL).collect()]
    assert got == ["()", "[error]"]


def test_one_pass_equals_per_group(spark):
    from tidepool.sources import fixtures as fx
    logs = fx.logs(spark, "/root/testdata/sf0.001")
    fast = al.parse_log(logs, "line").select("event_id", "log")
    slow = logs.select("event_id", al.parse_access_log("line").alias("log"))
    diff = fast.exceptAll(slow).count() + slow.exceptAll(fast).count()
    assert diff == 0


def test_status_class(spark):
    df = spark.createDataFrame([(c,) for c in (0, 199, 200, 299, 302, 500, 599, 600)], "c int")
    got = [r[0] for r in df.select(al.status_class(F.col("c"))).collect()]
    assert got == ["Other", "Other", "Success", "Success", "Other", "Failure", "Failure", "Other"]

"""Scale properties of the physical plans, checked on the planned queries."""

import contextlib
import io

import __spark_entry__ as se

from conftest import SF_SMALL


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue().split("\n\n")[0]


def _whole(spark, name) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        se.queries()[name](spark, SF_SMALL).explain("extended")
    return buf.getvalue()


def _tree(spark, name):
    return _plan(se.queries()[name](spark, SF_SMALL))


def test_sliding_two_shuffles_no_join(spark):
    for name in ("event_type_sliding_counts", "url_sliding_counts", "error_rate_alarm_ticks"):
        t = _tree(spark, name)
        assert t.count("Exchange") == 2, (name, t)
        assert "Join" not in t and "BroadcastExchange" not in t, (name, t)
        detail = _whole(spark, name)
        assert "RangeFrame" not in detail and "RowFrame" in detail, (name, detail)


def test_topk_limits_before_shuffle(spark):
    t = _tree(spark, "hashtag_topk").splitlines()
    partial = [i for i, l in enumerate(t) if "WindowGroupLimit" in l]
    exchanges = [i for i, l in enumerate(t) if "Exchange" in l]
    # the lower WindowGroupLimit (partial) sits below the window's exchange
    assert len(partial) == 2 and partial[0] < exchanges[0] < partial[1]


def test_gap_sessions_merge_twice(spark):
    """Seconds are combined below the first shuffle; sessions merge per hour, then per client."""
    for name in ("session_gap30", "session_gap_first10"):
        t = _tree(spark, name)
        assert t.count("MergingSessions") == 2 and t.count("Exchange") == 3 and t.count("Scan parquet") == 1, t


def test_first_clicks_read_the_table_once(spark):
    t = _tree(spark, "session_first10")
    assert t.count("Scan parquet") == 1 and t.count("Exchange") == 3, t


def test_running_totals_have_no_single_task(spark):
    for name in ("saved_rows_running_total", "text_length_by_batch"):
        t = _whole(spark, name).split("== Physical Plan ==")[1]
        assert "Window" in t and "SinglePartition" not in t, t


def test_scans_read_only_needed_columns(spark):
    df = se.queries()["url_sliding_counts"](spark, SF_SMALL)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    schema = [l for l in buf.getvalue().splitlines() if l.startswith("ReadSchema")]
    assert schema and all("props" not in s and "value" not in s for s in schema)


def test_no_python_udfs_in_batch_queries(spark):
    for name in ("url_sliding_counts", "hashtag_topk", "session_first10", "session_gap30",
                 "kmeans_predict", "linreg_predict", "log_parse_records"):
        t = _tree(spark, name)
        assert "Python" not in t and "ArrowEval" not in t and "BatchEval" not in t, name

"""Sessions, text statistics and the streaming models against brute force."""

import numpy as np
from pyspark.sql import functions as F

from tidepool.functions import accesslog as al
from tidepool.functions import text as tx
from tidepool.operators import kmeans, linreg, sessions
from tidepool.sources import fixtures as fx

from conftest import SF_SMALL


def test_first_clicks_brute_force(spark):
    visits = al.to_visits(fx.logs(spark, SF_SMALL), "line", keep=("event_id", "ts"))
    got = {r["ip"]: (r["session_length"], r["clickstream"])
           for r in sessions.session_first_clicks(visits).collect()}
    rows = sorted(visits.collect(), key=lambda r: (r["ts"], r["event_id"]))
    expect = {}
    for r in rows:
        n, clicks = expect.get(r["ip"], (0, []))
        expect[r["ip"]] = (n + 1, (clicks + [r["url"]])[:10])
    assert got == expect


def test_gap_sessions_brute_force(spark):
    visits = al.to_visits(fx.logs(spark, SF_SMALL), "line", keep=("event_id", "ts"))
    got = sorted((r["ip"] or "", r["session_start"], r["requests"])
                 for r in sessions.gap_sessions(visits).collect())
    by_ip = {}
    for r in visits.collect():
        by_ip.setdefault(r["ip"] or "", []).append(r["ts"])
    expect = []
    for ip, ts in by_ip.items():
        ts.sort()
        start, n, last = ts[0], 1, ts[0]
        for t in ts[1:]:
            if (t - last).total_seconds() >= 1800:
                expect.append((ip, start, n))
                start, n = t, 0
            n += 1
            last = t
        expect.append((ip, start, n))
    import calendar
    expect = sorted((ip, calendar.timegm(s.timetuple()), n) for ip, s, n in expect)
    assert got == expect


def test_utf16_length(spark):
    df = spark.createDataFrame([("a\U0001F600",), ("abc",), ("",)], "text string")
    assert [r[0] for r in df.select(tx.utf16_length("text")).collect()] == [3, 3, 0]


def test_stop_words_java_trim(spark):
    df = spark.createDataFrame([("The\t",), ("\x01my ",), ("Cat",), ("I'm",)], "w string")
    kept = [r["w"] for r in df.where(~tx.is_stop_word("w")).collect()]
    assert kept == ["Cat"]


def test_kmeans_update_from_zero_weight_is_mean(spark):
    pts = [(1.0, 1.0), (1.2, 0.8), (9.0, 9.0), (8.0, 10.0)]
    df = spark.createDataFrame([([a, b],) for a, b in pts], "features array<double>")
    model = kmeans.StreamingKMeansModel.given([[0.0, 0.0], [10.0, 10.0]])
    model.train_batch(df, "features")
    np.testing.assert_allclose(model.centres, [[1.1, 0.9], [8.5, 9.5]])
    np.testing.assert_allclose(model.weights, [2, 2])
    # decay 1.0 and fixed assignments: a second batch is a running mean
    model.train_batch(spark.createDataFrame([([1.4, 1.1],)], "features array<double>"), "features")
    np.testing.assert_allclose(model.centres[0], [(1.1 * 2 + 1.4) / 3, (0.9 * 2 + 1.1) / 3])


def test_kmeans_dying_cluster_split(spark):
    df = spark.createDataFrame([([5.0, 5.0],), ([6.0, 6.0],)], "features array<double>")
    model = kmeans.StreamingKMeansModel.given([[5.5, 5.5], [100.0, 100.0]])
    model.train_batch(df, "features")
    assert model.weights[0] == model.weights[1] == 1.0
    assert abs(model.centres[0][0] - model.centres[1][0]) < 1e-9


def test_regression_moments_sgd_approaches_ols(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=2000)
    y = -0.99 * x + 0.05 + rng.normal(scale=0.1, size=2000)
    df = spark.createDataFrame([(float(a), float(b), i % 10) for i, (a, b) in enumerate(zip(x, y))],
                               "x double, y double, b int")
    from tidepool.streaming.ml import linreg_replay
    model = linreg.StreamingLinearModel.zeros(1)
    out = linreg_replay(df, "y", ["x"], "b", model).orderBy("batch_id").collect()
    slope = df.agg(F.regr_slope("y", "x")).first()[0]
    assert abs(out[-1]["weights"][0] - slope) < 0.05
    # the moment form equals row-wise full-batch gradient descent
    first = df.where("b = 0").select("x", "y").toPandas()
    w = np.zeros(2)
    for i in range(1, 51):
        pred = w[0] * first.x + w[1]
        g = np.array([((pred - first.y) * first.x).mean(), (pred - first.y).mean()])
        prev = w.copy()
        w = w - 0.1 / np.sqrt(i) * g
        if i > 1 and np.linalg.norm(prev - w) < 0.001 * max(np.linalg.norm(w), 1.0):
            break
    np.testing.assert_allclose([out[0]["weights"][0], out[0]["intercept"]], w, rtol=1e-9)


def test_labeled_point_forms(spark):
    from tidepool.functions.vectors import parse_labeled_point, parse_vector
    df = spark.createDataFrame([("(1.0,[2.5,3])\r",), ("-1.74,1.66",), ("bad",)], "line string")
    got = [tuple(r[0]) for r in df.select(parse_labeled_point("line")).collect()]
    assert got[0] == (1.0, [2.5, 3.0], True)
    assert got[1] == (-1.74, [1.66], True)
    assert got[2][2] is False
    v = spark.createDataFrame([("[172153.58,22]\r",)], "line string").select(parse_vector("line"))
    assert v.first()[0] == [172153.58, 22.0]


def _numpy_kmeans_replay(points_by_batch, centres):
    c = np.array(centres, dtype=float)
    w = np.zeros(len(c))
    out = []
    for b, pts in points_by_batch:
        x = np.array(pts, dtype=float)
        d = ((x[:, None, :] - c[None, :, :]) ** 2).sum(axis=2)
        a = d.argmin(axis=1)
        for j in range(len(c)):
            m = (a == j).sum()
            if m:
                lam = m / (w[j] + m)
                c[j] = (1 - lam) * c[j] + lam * x[a == j].mean(axis=0)
                w[j] += m
        big, small = w.argmax(), w.argmin()
        if w[small] < 1e-8 * w[big]:
            w[big] = w[small] = (w[big] + w[small]) / 2
            p = 1e-14 * np.maximum(np.abs(c[big]), 1.0)
            c[small] = c[big] - p
            c[big] = c[big] + p
        out.append((b, c.copy(), w.copy()))
    return out


def test_kmeans_stream_query_brute_force(spark):
    from tidepool.plans import queries
    got = queries.kmeans_stream(spark, SF_SMALL).orderBy("batch_id", "cluster").collect()
    ev = fx.table(spark, SF_SMALL, "events").orderBy("event_id").collect()
    centres = [[r["value"], float(r["user_id"])] for r in ev[:kmeans.K]]
    import calendar
    batches = {}
    for r in ev:
        b = calendar.timegm(r["ts"].timetuple()) // 86400
        batches.setdefault(b, []).append([r["value"], float(r["user_id"])])
    expect = _numpy_kmeans_replay(sorted(batches.items()), centres)
    assert len(got) == len(expect) * kmeans.K
    for i, (b, c, w) in enumerate(expect):
        rows = got[i * kmeans.K:(i + 1) * kmeans.K]
        assert all(r["batch_id"] == b for r in rows)
        np.testing.assert_allclose([[r["c_0"], r["c_1"]] for r in rows], np.round(c, 6), atol=2e-6)
        np.testing.assert_allclose([r["weight"] for r in rows], w)


def test_linreg_sgd_stream_query_brute_force(spark):
    import calendar
    from tidepool.plans import queries
    got = queries.linreg_sgd_stream(spark, SF_SMALL).orderBy("batch_id").collect()
    li = fx.table(spark, SF_SMALL, "lineitem").select("l_quantity", "l_extendedprice", "l_shipdate").toPandas()
    x = li.l_quantity.to_numpy()
    xs = (x - x.mean()) / x.std()
    y = (li.l_extendedprice / 1000).to_numpy()
    b = np.array([calendar.timegm(t.timetuple()) // (365 * 86400) for t in li.l_shipdate])
    w = np.zeros(2)  # slope, intercept (carried)
    for i, batch in enumerate(sorted(set(b))):
        sel = b == batch
        X, Y = xs[sel], y[sel]
        prev = None
        for it in range(1, 51):
            g = np.array([((w[0] * X + w[1] - Y) * X).mean(), (w[0] * X + w[1] - Y).mean()])
            w = w - 0.1 / np.sqrt(it) * g
            if prev is not None and np.linalg.norm(prev - w) < 0.001 * max(np.linalg.norm(w), 1.0):
                break
            prev = w.copy()
        assert got[i]["batch_id"] == batch and got[i]["n"] == sel.sum()
        np.testing.assert_allclose([got[i]["weight"], got[i]["intercept"]], np.round(w, 6), atol=2e-6)


def test_trainers_roll_back_on_replayed_batch(spark):
    """A replayed micro-batch reloads the model of the batch before it."""
    from tidepool.session import shared_dir
    from tidepool.streaming.ml import kmeans_foreach_batch, linreg_foreach_batch
    b0 = spark.createDataFrame([([1.0, 1.0],), ([9.0, 9.0],)], "features array<double>")
    b1 = spark.createDataFrame([([2.0, 2.0],), ([8.0, 8.0],)], "features array<double>")
    start = [[0.0, 0.0], [10.0, 10.0]]
    once = kmeans_foreach_batch(kmeans.StreamingKMeansModel.given(start), "features",
                                shared_dir(spark, "km-once"))
    once(b0, 0)
    once(b1, 1)
    again = kmeans_foreach_batch(kmeans.StreamingKMeansModel.given(start), "features",
                                 shared_dir(spark, "km-again"))
    again(b0, 0)
    again(b1, 1)
    again(b1, 1)  # replay after a failure
    np.testing.assert_allclose(again.state["model"].centres, once.state["model"].centres)
    np.testing.assert_allclose(again.state["model"].weights, once.state["model"].weights)

    r0 = spark.createDataFrame([(1.0, 2.1), (2.0, 3.9)], "x double, y double")
    r1 = spark.createDataFrame([(3.0, 6.2), (4.0, 7.8)], "x double, y double")
    one = linreg_foreach_batch(linreg.StreamingLinearModel.zeros(1), "y", ["x"], shared_dir(spark, "lr1"))
    one(r0, 0)
    one(r1, 1)
    two = linreg_foreach_batch(linreg.StreamingLinearModel.zeros(1), "y", ["x"], shared_dir(spark, "lr2"))
    two(r0, 0)
    two(r1, 1)
    two(r1, 1)
    np.testing.assert_allclose(two.state["model"].weights, one.state["model"].weights)
    assert two.state["model"].intercept == one.state["model"].intercept


def test_linreg_train_then_score_in_one_batch(spark):
    from tidepool.session import shared_dir
    from tidepool.streaming.ml import linreg_foreach_batch
    rows = [(float(x), float(2.0 * x + 1.0), "train") for x in np.linspace(-1, 1, 50)]
    rows += [(0.5, -1.74, "test")]
    df = spark.createDataFrame(rows, "x double, y double, role string")
    out = shared_dir(spark, "lr-pred")
    run = linreg_foreach_batch(linreg.StreamingLinearModel.zeros(1), "y", ["x"],
                               shared_dir(spark, "lr-model"), role_col="role", predict_dir=out)
    run(df, 0)
    m = run.state["model"]
    got = spark.read.parquet(out).first()
    assert got["label"] == -1 and got["label_value"] == -1.74   # truncation toward zero
    assert abs(got["prediction"] - (m.weights[0] * 0.5 + m.intercept)) < 1e-12


def test_running_figures_over_blocks(spark):
    """Small blocks, so that all three levels hold several, gaps and negative numbers included."""
    from tidepool.operators.batches import running
    rows = [(b, (b * 37) % 11, (b * 13) % 101) for b in range(-20, 70) if b % 5]
    df = spark.createDataFrame(rows, "batch_id long, n long, longest long")
    got = running(df, "batch_id", {"total": ("n", "sum"), "top": ("longest", "max")}, block=3).orderBy("batch_id").collect()
    total = top = 0
    for (b, n, m), r in zip(rows, got, strict=True):
        total, top = total + n, max(top, m)
        assert (r["batch_id"], r["total"], r["top"]) == (b, total, top)


def test_small_helpers(spark):
    from tidepool.functions.timecols import epoch_seconds, from_epoch_seconds
    t = spark.createDataFrame([(1704067207,)], "s long").select(from_epoch_seconds("s").alias("t"))
    assert t.select(epoch_seconds("t")).first()[0] == 1704067207
    p = spark.createDataFrame([([2.0, 3.0],)], "f array<double>").select(
        linreg.predict_array("f", [0.5, -1.0], 0.25)).first()[0]
    assert p == 0.25 + 1.0 - 3.0


def test_trainers_go_on_after_a_restart(spark):
    """A second trainer on the same folder, an empty batch between, a non-zero initial weight."""
    from tidepool.session import shared_dir
    from tidepool.streaming.ml import kmeans_foreach_batch, linreg_foreach_batch
    points = [spark.createDataFrame([(x,) for x in b], "features array<double>")
              for b in ([[1.0, 1.0], [9.0, 9.0]], [], [[2.0, 2.0], [8.0, 8.0]])]
    start = lambda: kmeans.StreamingKMeansModel.given([[0.0, 0.0], [10.0, 10.0]], 3.0)
    whole = kmeans_foreach_batch(start(), "features", shared_dir(spark, "km-whole"))
    for i, b in enumerate(points):
        whole(b, i)
    folder = shared_dir(spark, "km-restart")
    kmeans_foreach_batch(start(), "features", folder)(points[0], 0)
    kmeans_foreach_batch(start(), "features", folder)(points[1], 1)
    last = kmeans_foreach_batch(start(), "features", folder)
    last(points[2], 2)
    np.testing.assert_allclose(last.state["model"].centres, whole.state["model"].centres)
    np.testing.assert_allclose(last.state["model"].weights, whole.state["model"].weights)
    last(points[0], 0)  # a replay of the first batch starts from the initial weight again
    once = kmeans_foreach_batch(start(), "features", shared_dir(spark, "km-first"))
    once(points[0], 0)
    np.testing.assert_allclose(last.state["model"].weights, once.state["model"].weights)

    rows = [spark.createDataFrame(b, "x double, y double") for b in ([(1.0, 2.1), (2.0, 3.9)], [], [(3.0, 6.2), (4.0, 7.8)])]
    whole = linreg_foreach_batch(linreg.StreamingLinearModel(np.array([0.5])), "y", ["x"], shared_dir(spark, "lr-whole"))
    for i, b in enumerate(rows):
        whole(b, i)
    folder = shared_dir(spark, "lr-restart")
    for i, b in enumerate(rows):
        last = linreg_foreach_batch(linreg.StreamingLinearModel(np.array([0.5])), "y", ["x"], folder)
        last(b, i)
    np.testing.assert_allclose(last.state["model"].weights, whole.state["model"].weights)
    assert last.state["model"].intercept == whole.state["model"].intercept


def test_sparse_and_malformed_vectors(spark):
    from tidepool.functions.vectors import parse_labeled_point, parse_vector
    lines = ["[1,2] junk", "(3,[0,2],[1.5,-2])", "[]", "(2,[5],[1])", "[1,,2]", "(0,[],[])", "[NaN, 1e3]"]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    got = [r[0] for r in df.select(parse_vector("line")).collect()]
    assert got[:6] == [None, [1.5, 0.0, -2.0], [], None, None, []] and np.isnan(got[6][0]) and got[6][1] == 1000.0
    points = ["(1,(2,[1],[4]))", "1,2 3,9", "(1,[2]) x", "(1,[2,3]"]
    df = spark.createDataFrame([(x,) for x in points], "line string")
    got = [tuple(r[0]) for r in df.select(parse_labeled_point("line")).collect()]
    assert got[0] == (1.0, [0.0, 4.0], True) and got[1] == (1.0, [2.0, 3.0], True)
    assert not got[2][2] and not got[3][2]


def test_sessions_split_at_idle_gaps(spark):
    """Five hours apart is two sessions, in batch form and in a stream whose batches come in any order."""
    from tidepool.session import shared_dir
    from tidepool.streaming.sessions import SessionPartsSink
    rows = [("a", 1, "2024-01-01 10:00:00", "/1"), ("a", 2, "2024-01-01 15:00:00", "/2"),
            ("a", 3, "2024-01-01 15:10:00", "/3"), ("b", 4, "2024-01-01 15:20:00", "/4")]
    df = spark.createDataFrame(rows, "ip string, event_id long, t string, url string")
    df = df.select("ip", "event_id", F.col("t").cast("timestamp_ntz").alias("ts"), "url")
    want = [("a", 1, ["/1"]), ("a", 2, ["/2", "/3"]), ("b", 1, ["/4"])]
    show = lambda d: sorted((r["ip"], r["requests"], r["clickstream"]) for r in d.collect())
    assert show(sessions.gap_first_clicks(sessions.second_parts(df))) == want
    sink = SessionPartsSink(shared_dir(spark, "gap-sessions"))
    for i, ids in enumerate(([3, 4], [1], [2], [2])):
        sink(df.where(F.col("event_id").isin(ids)), min(i, 2))  # the last one is a replay of batch 2
    assert show(sink.gap_sessions(spark)) == want
    snap = sorted((r["ip"], r["session_length"], r["clickstream"]) for r in sink.snapshot_sql(spark).collect())
    assert snap == want[1:]  # the session of 10:00 has timed out


def test_kmeans_scaling(spark):
    df = spark.createDataFrame([([100000.0 * i, 20.0 + i],) for i in range(10)], "features array<double>")
    mu, sd = kmeans.scaling_stats(df, "features", 2)
    scaled = kmeans.apply_scaling(df, "features", mu, sd).toPandas()
    x = np.array(scaled["features"].tolist())
    np.testing.assert_allclose(x.mean(axis=0), [0, 0], atol=1e-12)
    np.testing.assert_allclose(x.std(axis=0), [1, 1], atol=1e-12)


def test_filters_do_not_split_sessions(spark):
    """A filter on a session's times leaves its other requests alone, across hours as well."""
    start = 1_700_000_000
    seconds = {"a": range(0, 14_400, 600), "b": [0, 60, 5000, 5060, 20_000], "c": [3500, 3700, 7300]}
    rows = [(ip, start + t, f"/{ip}{t}") for ip, ts in seconds.items() for t in ts]
    visits = spark.createDataFrame(rows, "ip string, at long, url string").select(
        "ip", "url", F.timestamp_seconds("at").alias("ts"), F.col("at").alias("event_id"))
    want = []
    for ip, ts in seconds.items():
        own = [[t] for t in ts][:1]
        for t in list(ts)[1:]:
            if t - own[-1][-1] >= 1800:
                own.append([])
            own[-1].append(t)
        want += [(ip, start + o[0], start + o[-1] + 1800, len(o), [f"/{ip}{t}" for t in o[:10]]) for o in own]
    found = sessions.gap_first_clicks(sessions.second_parts(visits))
    plain = sessions.gap_sessions(visits)
    for at in (start + 1, start + 14_000, start + 5100, start + 9000, start + 21_000):
        late = sorted(w for w in want if w[2] > at)
        assert sorted(map(tuple, found.where(f"session_end > {at}").collect())) == late
        assert sorted(map(tuple, plain.where(f"session_end > {at}").collect())) == [w[:4] for w in late]
        early = sorted(w for w in want if w[1] < at)
        assert sorted(map(tuple, found.where(f"session_start < {at}").collect())) == early

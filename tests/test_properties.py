"""Randomized checks against plain-Python brute force (fixed seeds)."""

import random
import re
from collections import defaultdict
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidepool.functions import accesslog as al
from tidepool.operators import windows

FRAGMENTS = ["GET", "/a", "/b c", '"', '""', "x", " ", "  ", "HTTP/1.1", "\u0000", "é", "-", "[", "]", "200",
             "abc", "12", "u1"]


def _random_line(rng: random.Random) -> str:
    ip = rng.choice(["10.0.0.1", "1.2.3.4", "", "999.1.1.1", "a.b.c.d"])
    req = "".join(rng.choice(FRAGMENTS) for _ in range(rng.randint(0, 5)))
    agent = "".join(rng.choice(FRAGMENTS) for _ in range(rng.randint(0, 4)))
    status = rng.choice(["200", "503", "abc", "2000", "99"])
    when = rng.choice(["[01/Jan/2024:00:00:07 +0000]", "[x]", "[]", "01/Jan"])
    line = f'{ip} {rng.choice(["-", "c", ""])} {rng.choice(["u1", "-", ""])} {when} "{req}" {status} ' \
           f'{rng.choice(["12", "-", ""])} "{rng.choice(["-", "r"])}" "{agent}"'
    if rng.random() < 0.1:
        line = rng.choice(["junk ", " ", ""]) + line + rng.choice(["", "\n", " "])
    return line


def test_parse_matches_python_fullmatch(spark):
    rng = random.Random(11)
    lines = [_random_line(rng) for _ in range(3000)]
    df = spark.createDataFrame(list(enumerate(lines)), "id int, line string")
    got = {r["id"]: r["log"] for r in al.parse_log(df, "line").select("id", "log").collect()}
    pat = re.compile(al.ACCESS_LOG_PATTERN, re.ASCII)
    matched = 0
    for i, line in enumerate(lines):
        m = pat.fullmatch(line)
        g = got[i]
        assert g["matched"] == (m is not None), repr(line)
        if m:
            matched += 1
            groups = list(m.groups())
            groups[0] = groups[0] or None
            assert [g[name] for name in al.GROUP_NAMES] == groups, repr(line)
        else:
            assert all(g[name] is None for name in al.GROUP_NAMES)
    assert 100 < matched < len(lines)


def test_step_function_matches_brute_force(spark):
    rng = random.Random(5)
    base = datetime(2024, 1, 1, 23, 40)
    rows = [(rng.choice(["a", "b", None]), base + timedelta(seconds=rng.randint(0, 3600),
                                                            microseconds=rng.randint(0, 999999)))
            for _ in range(1500)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz")
    w = 120
    got = {(r["k"], r["tick"]): r["n"] for r in
           windows.sliding_sums(df, "k", None, "ts", f"{w} seconds", "1 second", period="1 hour",
                                keep_zero=True).collect()}
    epoch = datetime(1970, 1, 1)
    secs = defaultdict(list)
    for k, t in rows:
        secs[k].append(int((t - epoch).total_seconds() // 1))
    expect = {}
    for k, ss in secs.items():
        counts = defaultdict(int)
        for s in ss:
            counts[s] += 1
        candidates = sorted(set(counts) | {s + w for s in counts})
        prev = 0
        for t in candidates:
            n = sum(c for s, c in counts.items() if t - w < s <= t)
            if n != prev:
                expect[(k, t)] = n
            prev = n
    assert got == expect

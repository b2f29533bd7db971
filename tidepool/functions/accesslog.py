"""Apache combined-log parsing as column expressions (PRJ1-PRJ8).

``parse_log`` runs the full-line pattern ONCE per line: a ``regexp_replace``
rewrites a matching line into its nine groups joined by NUL, a line that does
not match comes back unchanged. Its split is materialized in its own
projection (Catalyst does not inline a non-cheap expression used many times),
and the struct fields are cheap ``get`` calls on that array. Lines that
themselves contain NUL take the exact per-group path (``rlike`` +
``regexp_extract``) so the NUL separator can never be ambiguous.

The row projections below (records, rows, visits, status classes) are built on
the parsed struct, so a query that needs one field still pays one regex pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's log format) -------------------
# Combined log format: ip (optional), client, user, [datetime], "request",
# status (3 digits), bytes, "referer", "agent"; the line must match in full.
ACCESS_LOG_PATTERN = (
    r'(\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})? (\S+) (\S+) (\[.+?\]) "(.*?)" (\d{3}) (\S+) "(.*?)" "(.*?)"'
)
GROUP_NAMES = ("ip", "client", "user", "datetime", "request", "status", "bytes", "referer", "agent")
# Labels the reference emits for lines or requests it cannot use.
ERROR_LABEL = "[error]"          # bad request / unmatched line, strict url
UNMATCHED_LABEL = "error"        # unmatched line in record projections
LEAK_LABEL = "()"                # what a missing else-branch turns into as a key
# -----------------------------------------------------------------------------

# Spark's regexp functions are find-style; \A...\z makes them whole-string
# matches (``$`` would also accept a trailing newline).
FULL_MATCH = r"\A" + ACCESS_LOG_PATTERN + r"\z"
_SEP = "\u0000"
_GROUPS_JOINED = _SEP.join(f"${i}" for i in range(1, len(GROUP_NAMES) + 1))


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ----------------------------------------------------- per-group (exact, slow)
def log_matches(line) -> Column:
    """True when the whole line is a combined-log record."""
    return _col(line).rlike(FULL_MATCH)


def log_group(line, name: str) -> Column:
    """One capture group by name; NULL for lines that do not match.

    ``regexp_extract`` gives '' both for no match and for an empty optional
    group, so the match flag decides, and an absent ip becomes NULL.
    """
    idx = GROUP_NAMES.index(name) + 1
    value = F.regexp_extract(_col(line), FULL_MATCH, idx)
    if name == "ip":
        value = F.nullif(value, F.lit(""))
    return F.when(log_matches(line), value)


# ------------------------------------------------------ one pass per line
def parse_log(df: DataFrame, line: str = "line", out: str = "log") -> DataFrame:
    """Add struct ``out``: ``matched`` + the nine groups (NULL when not matched).

    Three small projections keep the plan compact: (1) the rewritten line split
    on NUL, (2) the match flag and the group array -- from (1) normally, from
    nine ``regexp_extract`` calls only for lines holding a NUL themselves --
    and (3) the struct, whose fields are plain array reads.
    """
    rep, m, parts = f"_{out}_rep", f"_{out}_m", f"_{out}_parts"
    has_sep = F.instr(F.col(line), _SEP) > 0
    staged = df.withColumn(rep, F.split(
        F.regexp_replace(F.col(line), FULL_MATCH, _GROUPS_JOINED), _SEP))
    exact = F.array(*[F.regexp_extract(F.col(line), FULL_MATCH, i)
                      for i in range(1, len(GROUP_NAMES) + 1)])
    staged = staged.select(
        "*",
        # an unmatched line comes back unchanged: one element, as it holds no NUL
        F.when(has_sep, log_matches(line)).otherwise(F.size(rep) == len(GROUP_NAMES)).alias(m),
        F.when(has_sep, exact).otherwise(F.col(rep)).alias(parts))
    fields = [F.col(m).alias("matched")]
    for i, g in enumerate(GROUP_NAMES):
        value = F.get(F.col(parts), i)
        if g == "ip":
            value = F.nullif(value, F.lit(""))
        fields.append(F.when(F.col(m), value).alias(g))
    return staged.withColumn(out, F.struct(*fields)).drop(rep, m, parts)


def parse_access_log(line) -> Column:
    """Per-group form of :func:`parse_log` as one column expression."""
    fields = [log_matches(line).alias("matched")]
    fields += [log_group(line, g).alias(g) for g in GROUP_NAMES]
    return F.struct(*fields)


def request_tokens(request) -> Column:
    """Split a request on single spaces like ``String.split(" ")``.

    Java drops trailing empty tokens while Spark's ``split`` keeps them, so
    trailing spaces are trimmed first.
    """
    return F.split(F.rtrim(_col(request)), " ")


def url_strict(log="log", bad_request_label: str = ERROR_LABEL) -> Column:
    """PRJ2/PRJ3 on a parsed struct: token 1 of a 3-token request, else a label.

    Unmatched lines give ``[error]``. A matched request that is not exactly
    three tokens gives ``bad_request_label``: ``[error]`` (PRJ2) or ``()`` for
    parity with the reference jobs that leak the Unit value as a key (PRJ3).
    """
    s = _col(log)
    toks = request_tokens(s["request"])
    return (F.when(~s["matched"], F.lit(ERROR_LABEL))
             .when(F.size(toks) == 3, F.get(toks, 1))
             .otherwise(F.lit(bad_request_label)))


def url_loose(log="log") -> Column:
    """PRJ4: token 1 when present, ``[error]`` otherwise; ``error`` if unmatched."""
    s = _col(log)
    toks = request_tokens(s["request"])
    return (F.when(~s["matched"], F.lit(UNMATCHED_LABEL))
             .otherwise(F.coalesce(F.get(toks, 1), F.lit(ERROR_LABEL))))


def status_code(log="log") -> Column:
    """Status group as int; 0 when the line does not match."""
    return F.coalesce(_col(log)["status"].cast("int"), F.lit(0))


def status_class(code) -> Column:
    """PRJ8: 2xx Success, 5xx Failure, anything else Other."""
    c = _col(code)
    return (F.when((c >= 200) & (c < 300), F.lit("Success"))
             .when((c >= 500) & (c < 600), F.lit("Failure"))
             .otherwise(F.lit("Other")))


def matched_or(log, field: str, label: str = UNMATCHED_LABEL) -> Column:
    s = _col(log)
    return F.when(s["matched"], s[field]).otherwise(F.lit(label))


def _keep(keep) -> list:
    return [F.col(k) for k in (keep or ())]


def to_records(df: DataFrame, line: str = "line", keep=()) -> DataFrame:
    """PRJ5: ``(url, status, agent)``; unmatched lines give ``(error, 0, error)``."""
    p = parse_log(df, line)
    return p.select(*_keep(keep), url_loose().alias("url"), status_code().alias("status"),
                    matched_or("log", "agent").alias("agent"))


def to_rows(df: DataFrame, line: str = "line", keep=()) -> DataFrame:
    """PRJ6: ``(ip, url, status, user_agent)``; unmatched give ``(error, error, 0, error)``.

    A matched line without an ip keeps ip NULL.
    """
    p = parse_log(df, line)
    return p.select(*_keep(keep), matched_or("log", "ip").alias("ip"), url_loose().alias("url"),
                    status_code().alias("status"), matched_or("log", "agent").alias("user_agent"))


def to_visits(df: DataFrame, line: str = "line", keep=()) -> DataFrame:
    """PRJ7: ``(ip, url)``; unmatched lines give ``(error, error)``."""
    p = parse_log(df, line)
    return p.select(*_keep(keep), matched_or("log", "ip").alias("ip"), url_loose().alias("url"))


def to_status_classes(df: DataFrame, line: str = "line", keep=()) -> DataFrame:
    """PRJ8 as a projection: ``(status, status_class)``."""
    p = parse_log(df, line)
    return p.select(*_keep(keep), status_code().alias("status"),
                    status_class(status_code()).alias("status_class"))


def to_strict_urls(df: DataFrame, line: str = "line", keep=(), bad_request_label: str = ERROR_LABEL,
                   out: str = "url") -> DataFrame:
    """PRJ2/PRJ3 as a projection."""
    p = parse_log(df, line)
    return p.select(*_keep(keep), url_strict("log", bad_request_label).alias(out))

"""Quality rules whose cutoffs come from labelled holdouts with exact binomial bounds.

Per text: counts over words and lines, all inside one row by array expressions
(no row is exploded, nothing is shuffled but counts). Each rule compares one of
these figures with a cutoff. The cutoff of a rule in a stratum is chosen so:

* the labelled documents that the base rules keep are split by a hash of their
  id into a tuning half and a holdout half;
* a rule's cutoffs form a sequence from lenient to strict. On the holdout's good
  documents, a cutoff is *certified* if the exact binomial probability of seeing
  at most its number of false rejections, were the true rate at the limit, is at
  most the rule's share of the error allowance. Testing stops at the first
  cutoff that fails, so a sequence needs no correction of its own; over rules
  and strata the allowance is divided (Bonferroni), and the rate limit is divided
  over the rules, so all rules together keep it;
* of the certified cutoffs, the strictest one whose rejections in the tuning
  half are mostly bad documents is used. Without one the rule rejects nothing
  in that stratum.

Defined cases: a null text has no words; a null stratum is a stratum of its own
(``?``), and one without labels rejects nothing beyond the base rules;
contradicting labels of one id are ignored, repeated ones count once; repeated
rows and null ids give a row each; extra columns are ignored by ``judge`` and
passed on by ``keep``; a document that no figure rejects is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import SPACE, written

#: Base rules: fewest words; most of the words, in hundredths, that repeated 3-word windows may hold.
LEAST_WORDS, MOST_REPEATED = 50, 50
#: At most this share of good documents may be lost to the calibrated rules, in each stratum, ...
LOSS_LIMIT = 0.05
#: ... with this probability of being wrong about any rule or stratum.
ERROR = 0.05
#: A cutoff is of use if this share at least of what it rejects is bad.
LEAST_BAD = 0.8

#: The rules: figure and cutoffs from lenient to strict; a text is rejected above the cutoff.
RULES: dict[str, tuple[str, list[float]]] = {
    "symbols_per_100_words": ("100D * n_symbols / n_words", [300, 200, 100, 50, 25, 10]),
    "repeated_per_100_words": ("100D * n_repeat_words / n_words", [45, 40, 35, 30, 25, 20]),
    "dup_lines_per_100_words": ("100D * n_dup_lines / n_words", [20, 15, 10, 8, 6, 4]),
    "chars_per_word": ("1D * word_chars / n_words", [40, 30, 25, 20, 17, 15]),
    "words_per_100_chars": ("100D * n_words / word_chars", [70, 60, 50, 45, 40, 35]),
}
FIGURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def with_figures(df: DataFrame, text: Column) -> DataFrame:
    """Adds the counts as struct ``_q``.

    Repeated 3-word windows: the windows' hashes are sorted with their positions,
    so equal windows lie side by side; neighbours of one hash are compared word by word.
    """
    text = F.coalesce(text, F.lit(""))
    df = df.withColumn("_t", text)
    df = df.withColumn("_w", F.array_remove(F.split("_t", SPACE), ""))
    lines = F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.withColumn("_l", lines)
    df = df.select(
        *[c for c in df.columns if c not in ("_t", "_w", "_l")],
        F.size("_w").cast("long").alias("_n"),
        F.length(F.regexp_replace("_t", SPACE, "")).cast("long").alias("_c"),
        (F.length("_t") - F.length(F.regexp_replace("_t", r"[#*$%&|<>]+", ""))).cast("long").alias("_s"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("_d"),
        "_w", F.transform("_w", lambda w: F.xxhash64(w)).alias("_h"))
    window = F.expr("transform(sequence(0, size(_h) - 3), i -> struct(xxhash64(_h[i], _h[i + 1], _h[i + 2]) AS h, i AS i))")
    df = df.withColumn("_k", F.when(F.col("_n") >= 4, F.sort_array(window)))

    def same(j: str) -> str:
        words = " AND ".join(f"_w[_k[{j}].i + {o}] = _w[x.i + {o}]" for o in range(3))
        return f"(_k[{j}].h = x.h AND {words})"

    again = F.expr(f"filter(_k, (x, i) -> (i > 0 AND {same('i - 1')}) OR (i + 1 < size(_k) AND {same('i + 1')}))")
    df = df.withColumn("_a", F.sort_array(F.transform(again, lambda x: x["i"].cast("long"))))
    covered = F.expr("aggregate(transform(_a, (p, i) -> least(3L, coalesce(get(_a, i + 1) - p, 3L))), 0L, (s, x) -> s + x)")
    figures = F.struct(F.col("_n").alias("n_words"), F.col("_c").alias("word_chars"), F.col("_s").alias("n_symbols"),
                       F.col("_d").alias("n_dup_lines"),
                       F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"))
    return df.withColumn("_q", figures).drop("_n", "_c", "_s", "_d", "_w", "_h", "_k", "_a")


def _base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def _log_factorial(n: Column) -> Column:
    """ln n!: from the factorial up to 20, beyond by Stirling's series (error below 1e-13)."""
    x = n.cast("double")
    series = (x * F.log(x) - x + 0.5 * F.log(2 * F.pi() * x)
              + 1 / (12 * x) - 1 / (360 * F.pow(x, F.lit(3))) + 1 / (1260 * F.pow(x, F.lit(5))))
    return F.when(n <= 20, F.log(F.factorial(F.least(n, F.lit(20)).cast("int")).cast("double"))).otherwise(series)


def binomial_tail(k: Column, n: Column, rate: float) -> Column:
    """P(Binomial(n, rate) <= k) for long k < n * rate; 1 beyond, where no bound can hold.

    Summed from its largest term at k downward, as many terms as can matter.
    """
    first = (_log_factorial(n) - _log_factorial(k) - _log_factorial(n - k)
             + k * F.log(F.lit(rate)) + (n - k) * F.log1p(F.lit(-rate)))
    steps = F.least(k, F.ceil(40 * F.sqrt(n * rate)).cast("long") + 50)
    state = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))
    odds = (1 - rate) / rate

    def add(s: Column, i: Column) -> Column:
        term = s["term"] * (k - i) * odds / (n - k + i + 1)
        return F.struct(term.alias("term"), (s["sum"] + term).alias("sum"))

    ratios = F.aggregate(F.sequence(F.lit(0).cast("long"), steps), state, add, lambda s: s["sum"])
    return F.when(k >= n * rate, F.lit(1.0)).otherwise(F.exp(first) * ratios)


def calibrate(figures: DataFrame, labels: DataFrame, loss: float = LOSS_LIMIT, error: float = ERROR) -> DataFrame:
    """(stratum, rule, cutoff) from figures (doc_id, stratum, counts) and labels (doc_id, quality)."""
    known = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.min("quality").alias("lo"), F.max("quality").alias("hi"))
             .where("lo = hi").select("doc_id", F.col("lo").alias("good")))
    rows = figures.where(~_base_failed()).join(known, "doc_id")
    held = F.substring(F.md5(F.col("doc_id").cast("string")), 1, 1) < "8"
    tests = F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(i).alias("step"), F.lit(float(c)).alias("cutoff"),
                               (F.expr(figure) > c).alias("rejected"))
                      for name, (figure, cutoffs) in RULES.items() for i, c in enumerate(cutoffs)])
    one = lambda x: F.sum(F.when(x, 1).otherwise(0))
    good = F.col("good") == 1
    # first to counts of each pattern of outcomes: few rows, however many documents
    counts = (rows.select("stratum", held.alias("held"), good.alias("good"), tests.alias("tests"))
              .groupBy("stratum", "held", "good", "tests").agg(F.count("*").alias("times"))
              .select("stratum", "held", "good", "times", F.inline("tests"))
              .groupBy("stratum", "rule", "step", "cutoff")
              .agg(F.sum(F.when(F.col("held") & F.col("good"), F.col("times")).otherwise(0)).alias("n"),
                   F.sum(F.when(F.col("held") & F.col("good") & F.col("rejected"), F.col("times")).otherwise(0)).alias("k"),
                   F.sum(F.when(~F.col("held") & F.col("rejected"), F.col("times")).otherwise(0)).alias("hits"),
                   F.sum(F.when(~F.col("held") & F.col("rejected") & ~F.col("good"), F.col("times")).otherwise(0)).alias("bad")))
    strata = counts.groupBy(F.lit(True).alias("all")).agg(F.count_distinct("stratum").alias("strata"))
    share = F.lit(error) / (len(RULES) * F.col("strata"))
    tested = counts.withColumn("all", F.lit(True)).join(strata, "all").withColumn(
        "certified", (F.col("n") > 0) & (binomial_tail(F.col("k"), F.col("n"), loss / len(RULES)) <= share))
    steps = tested.groupBy("stratum", "rule").agg(
        F.min(F.when(~F.col("certified"), F.col("step"))).alias("stop"),
        F.collect_list(F.struct("step", "cutoff", "hits", "bad")).alias("steps"))  # one for each cutoff
    usable = F.filter("steps", lambda s: (s["step"] < F.coalesce(F.col("stop"), F.lit(1 << 20)))
                      & (s["hits"] > 0) & (s["bad"] >= LEAST_BAD * s["hits"]))
    return (steps.select("stratum", "rule", F.array_max(usable)["cutoff"].alias("cutoff"))
            .where(F.col("cutoff").isNotNull()))


def _judged(df: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Adds base_failed, kept and failed_rule to rows with stratum and counts."""
    by_rule = (cutoffs.groupBy("stratum").pivot("rule", list(RULES)).agg(F.first("cutoff"))
               .withColumnsRenamed({name: f"_cut_{name}" for name in RULES}))
    df = df.join(by_rule, "stratum", "left")
    failed = F.coalesce(*[F.when(F.expr(figure) > F.col(f"_cut_{name}"), F.lit(name)) for name, (figure, _) in RULES.items()])
    df = df.withColumn("base_failed", _base_failed())
    df = df.withColumn("failed_rule", F.when(~F.col("base_failed"), failed))
    return df.withColumn("kept", ~F.col("base_failed") & F.col("failed_rule").isNull()) \
        .drop(*[f"_cut_{name}" for name in RULES])


def _figures(docs: DataFrame, text_col: str, id_col: str, stratum_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(stratum_col).cast("string"), F.lit("?")).alias("stratum"),
                       F.col(text_col).alias("text"))
    return with_figures(rows, F.col("text")).select("doc_id", "stratum", "_q.*")


def judge(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id",
          stratum_col: str = "lang") -> DataFrame:
    """doc_id, the five counts, base_failed, kept, failed_rule for every document."""
    figures = written(_figures(docs, text_col, id_col, stratum_col), "quality-figures")
    cutoffs = written(calibrate(figures, labels), "quality-cutoffs")
    return _judged(figures, cutoffs).select("doc_id", *FIGURES, "base_failed", "kept", "failed_rule")


def keep(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id",
         stratum_col: str = "lang") -> DataFrame:
    """The documents that are kept, with their own columns.

    The counts are computed twice, for the cutoffs and for the decision: that
    is cheaper than sending or writing every text in between.
    """
    figures = written(_figures(docs, text_col, id_col, stratum_col), "quality-figures")
    cutoffs = written(calibrate(figures, labels), "quality-cutoffs")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"))
    rows = with_figures(whole, F.col(f"_doc.`{text_col}`"))
    # a condition on the row number keeps Spark from moving the filter, and with it a copy of
    # every count's expression for each use of it, below the counts
    rows = rows.select("_doc", F.coalesce(F.col(f"_doc.`{stratum_col}`").cast("string"), F.lit("?")).alias("stratum"),
                       "_q", F.monotonically_increasing_id().alias("_row")).select("_doc", "stratum", "_q.*", "_row")
    return _judged(rows, cutoffs).where("kept AND _row >= 0").select("_doc.*")


def _steps_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT rn, '{name}' AS rule, {r} AS ord, s.step, s.cutoff, {figure.replace('D ', '::DOUBLE ')} AS figure FROM q, "
        f"(VALUES {', '.join(f'({i}, {float(c)}::DOUBLE)' for i, c in enumerate(cutoffs))}) s(step, cutoff) "
        "WHERE NOT base_failed"
        for r, (name, (figure, cutoffs)) in enumerate(RULES.items()))


#: The common table expressions that judge all rows of ``documents``; the pipeline's SQL uses them, too.
JUDGED_SQL = f"""
d AS MATERIALIZED (SELECT doc_id, lang, coalesce(text, '') AS text, row_number() OVER () AS rn FROM documents),
w AS MATERIALIZED (SELECT rn, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
g AS (SELECT rn, i, ws[i] || chr(0) || ws[i + 1] || chr(0) || ws[i + 2] AS t
      FROM (SELECT rn, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
a AS (SELECT rn, i FROM g QUALIFY count(*) OVER (PARTITION BY rn, t) > 1),
r AS (SELECT rn, sum(least(3, coalesce(nx - i, 3)))::BIGINT AS n
      FROM (SELECT rn, i, lead(i) OVER (PARTITION BY rn ORDER BY i) AS nx FROM a) GROUP BY rn),
l AS (SELECT rn, count(*) - count(DISTINCT line) AS n
      FROM (SELECT rn, unnest(string_split(text, chr(10))) AS line FROM d)
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rn),
f AS MATERIALIZED (
  SELECT rn, doc_id, coalesce(lang, '?') AS stratum, len(ws)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(l.n, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words
  FROM d JOIN w USING (rn) LEFT JOIN l USING (rn) LEFT JOIN r USING (rn)),
q AS MATERIALIZED (
  SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed FROM f),
x AS MATERIALIZED ({_steps_sql()}),
known AS (SELECT doc_id, min(quality) AS good FROM labels WHERE quality IN (0, 1) AND doc_id IS NOT NULL
          GROUP BY doc_id HAVING min(quality) = max(quality)),
tested AS (
  SELECT stratum, rule, step, cutoff,
    count(*) FILTER (WHERE held AND good = 1) AS n,
    count(*) FILTER (WHERE held AND good = 1 AND figure > cutoff) AS k,
    count(*) FILTER (WHERE NOT held AND figure > cutoff) AS hits,
    count(*) FILTER (WHERE NOT held AND figure > cutoff AND good = 0) AS bad
  FROM (SELECT *, md5(doc_id::VARCHAR)[1] < '8' AS held FROM x JOIN q USING (rn) JOIN known USING (doc_id))
  GROUP BY ALL),
bound AS (
  SELECT *, n > 0 AND k < n * {LOSS_LIMIT / len(RULES)} AND list_sum(list_transform(range(0, k + 1), lambda j: exp(
      lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1)
      + j * ln({LOSS_LIMIT / len(RULES)}::DOUBLE) + (n - j) * ln(1 - {LOSS_LIMIT / len(RULES)}::DOUBLE))))
    <= {ERROR}::DOUBLE / ({len(RULES)} * (SELECT count(DISTINCT stratum) FROM tested)) AS certified FROM tested),
cut AS (
  SELECT stratum, rule, max_by(cutoff, step) AS cutoff
  FROM (SELECT *, min(step) FILTER (WHERE NOT certified) OVER (PARTITION BY stratum, rule) AS stop FROM bound)
  WHERE step < coalesce(stop, 1000000) AND hits > 0 AND bad >= {LEAST_BAD} * hits GROUP BY ALL),
judged AS MATERIALIZED (
  SELECT q.*, v.failed_rule, NOT base_failed AND v.failed_rule IS NULL AS kept
  FROM q LEFT JOIN (
    SELECT rn, min_by(x.rule, ord) AS failed_rule FROM x JOIN q USING (rn)
    JOIN cut ON cut.stratum = q.stratum AND cut.rule = x.rule AND figure > cut.cutoff
    GROUP BY rn) v USING (rn))"""

ORACLE_SQL = f"""WITH {JUDGED_SQL}
SELECT doc_id, {', '.join(FIGURES)}, base_failed, kept, failed_rule FROM judged"""

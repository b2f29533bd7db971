"""URL filters: rules indexed by their rarest literal token.

Two kinds of rules share one index. A *list rule* is a host with an optional
path (``example.org/es/``): it fits that host and its subdomains where the
url's path starts with the rule's; the longest fitting one decides. A *pattern
rule* is matched anywhere in the lower-cased url (``*`` any characters, ``^`` a
separator or the end) and only decides where no list rule fits; block wins
over allow.

Every rule has literal tokens (runs of letters and digits that a fitting url
holds as whole runs, too). A rule is filed under the one of its tokens that the
fewest urls hold. A url's tokens fetch the rules filed under them, and only
those rules' regular expressions run. A rule without a usable token is filed
under the empty token, which every url holds.

Plan: different urls once (partial aggregation, so a url or host that a third
of the rows share costs one row), their tokens, a join with the small index,
an aggregation by url, and a join of the decisions back to the pages. All of it
is DataFrame expressions.

Defined cases: a null url or one without ``://`` has an empty host and path and
no list rule; repeated rows each get the decision; null page ids stay null;
extra columns are ignored; two fitting rules of one length: the smaller string;
an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The list rules of the contract.
LIST_RULES = [
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
]

#: Pages that hold no article of their own.
PATTERN_RULES = [
    ("/wp-admin/", "block"),
    ("/wp-login.php", "block"),
    ("/cgi-bin/", "block"),
    ("/cart/", "block"),
    ("/checkout/", "block"),
    ("/login^", "block"),
    ("/logout^", "block"),
    ("/signup^", "block"),
    ("?sessionid=*", "block"),
    ("&sessionid=*", "block"),
    ("://ads.*", "block"),
    ("://*/search?q=*", "block"),
    ("/print/*", "block"),
    (".exe^", "block"),
    (".zip^", "block"),
    ("/robots.txt^", "allow"),
]

_TOKEN = "[A-Za-z0-9]+"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _literal(text: Column) -> Column:
    return F.regexp_replace(text, r"([^A-Za-z0-9])", r"\\$1")


def rules_table(spark: SparkSession, rules: list[tuple[str, str]], kind: str) -> DataFrame:
    """(rule, action, kind) as a table that Spark knows the size of."""
    rows = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(a).alias("action")) for r, a in rules])
    return spark.range(1).select(F.inline(rows)).withColumn("kind", F.lit(kind))


def _compiled(rules: DataFrame) -> DataFrame:
    """Adds each rule's regular expression and literal tokens."""
    rule = F.col("rule")
    host, path = F.regexp_extract(rule, r"^([^/]*)", 1), F.regexp_extract(rule, r"^[^/]*(.*)$", 1)
    listed = F.concat(F.lit(r"^(?:[^/]*\.)?"), _literal(host), _literal(path))
    pattern = F.regexp_replace(F.regexp_replace(_literal(rule), r"\\\*", ".*"),
                               r"\\\^", F.lit(r"(?:[^A-Za-z0-9_.%-]|\$)"))
    # a run that the rule bounds on both sides; a list rule's host is bounded by itself
    bounded = F.regexp_extract_all(rule, F.lit(r"(?<=[^A-Za-z0-9*])[A-Za-z0-9]+(?=[^A-Za-z0-9*])"), F.lit(0))
    in_host = F.regexp_extract_all(host, F.lit(_TOKEN), F.lit(0))
    in_path = F.regexp_extract_all(path, F.lit(r"(?<![A-Za-z0-9])[A-Za-z0-9]+(?=[^A-Za-z0-9])"), F.lit(0))
    is_list = F.col("kind") == "list"
    tokens = F.when(is_list, F.concat(in_host, in_path)).otherwise(bounded)
    return rules.select("rule", "action", "kind",
                        F.when(is_list, listed).otherwise(F.concat(F.lit("(?s)"), pattern)).alias("regex"),
                        F.transform(F.array_distinct(tokens), F.lower).alias("tokens"))


def _index(rules: DataFrame, url_tokens: DataFrame) -> DataFrame:
    """Each rule under the one of its tokens that the fewest urls hold."""
    by_token = rules.select("rule", "kind", F.explode_outer("tokens").alias("token"))
    counts = (url_tokens.join(by_token.select("token").distinct(), "token", "left_semi")
              .groupBy("token").agg(F.count("*").alias("n")))
    best = (by_token.join(counts, "token", "left")
            .groupBy("rule", "kind")
            .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("token", F.lit("")).alias("token")))
                 .alias("m")))
    return rules.drop("tokens").join(best.select("rule", "kind", F.col("m.token").alias("token")), ["rule", "kind"])


def judge_urls(pages: DataFrame, list_rules: DataFrame, pattern_rules: DataFrame,
               id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """page_id, host, path, rule (null where no list rule fits), verdict, pattern."""
    pages = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    rules = _compiled(list_rules.unionByName(pattern_rules))
    urls = pages.where(F.col("url").contains("://")).select("url").distinct()
    tokens = urls.select("url", F.explode(F.array_distinct(F.concat(
        F.regexp_extract_all(F.lower("url"), F.lit("[a-z0-9]+"), F.lit(0)), F.array(F.lit(""))))).alias("token"))
    subject = F.when(F.col("kind") == "list", F.concat(host_of(F.col("url")), path_of(F.col("url")))) \
        .otherwise(F.lower("url"))
    fits = F.rlike(subject, F.col("regex"))
    listed = F.col("kind") == "list"
    # the longest, of equal ones the smaller string: the least of (-length, rule, action)
    best_list = F.min(F.when(listed, F.struct((-F.length("rule")).alias("l"), "rule", "action")))
    best_pattern = F.min(F.when(~listed, F.struct((F.col("action") != "block").alias("o"), "rule", "action")))
    judged = (tokens.join(_index(rules, tokens), "token").where(fits)
              .groupBy("url").agg(best_list.alias("l"), best_pattern.alias("p")))
    return pages.join(judged, "url", "left").select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
        F.col("l.rule").alias("rule"),
        F.coalesce("l.action", "p.action", F.lit(default)).alias("verdict"),
        F.when(F.col("l").isNull(), F.col("p.rule")).alias("pattern"))


def judge_pages(pages: DataFrame) -> DataFrame:
    spark = pages.sparkSession
    return judge_urls(pages, rules_table(spark, LIST_RULES, "list"), rules_table(spark, PATTERN_RULES, "pattern"))


def _patterns_sql() -> str:
    out = []
    for i, (rule, action) in enumerate(PATTERN_RULES):
        regex = "".join({"*": ".*", "^": "([^A-Za-z0-9_.%-]|$)"}.get(c, c if c.isalnum() else "\\" + c) for c in rule)
        out.append(f"({i}, '{rule}', '{action}', '(?s){regex}')")
    return ", ".join(out)


#: The same decisions by trying every rule on every url.
ORACLE_SQL = f"""
WITH p AS (
  SELECT page_id, url,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
    row_number() OVER () AS rn
  FROM pages),
l(rule, action, host, path) AS (VALUES
  ('org/', 'allow', 'org', '/'), ('example.org/es/', 'block', 'example.org', '/es/'),
  ('example.org/en/1', 'block', 'example.org', '/en/1'), ('com/fr/', 'allow', 'com', '/fr/'),
  ('com/de/', 'block', 'com', '/de/')),
g(n, rule, action, regex) AS (VALUES {_patterns_sql()}),
best AS (
  SELECT rn, min(struct_pack(l := -length(rule), r := rule, a := action)) AS m
  FROM p JOIN l ON (p.host = l.host OR ends_with(p.host, '.' || l.host)) AND starts_with(p.path, l.path)
  GROUP BY rn),
other AS (
  SELECT rn, min(struct_pack(o := CASE WHEN action = 'block' THEN 0 ELSE 1 END, r := rule, a := action)) AS m
  FROM p JOIN g ON contains(url, '://') AND regexp_matches(lower(url), regex) GROUP BY rn)
SELECT page_id, host, path, best.m.r AS rule, coalesce(best.m.a, other.m.a, 'allow') AS verdict,
  CASE WHEN best.m IS NULL THEN other.m.r END AS pattern
FROM p LEFT JOIN best USING (rn) LEFT JOIN other USING (rn)
"""

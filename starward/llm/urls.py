"""URL filters: a given list of rules, and rules mined from labelled pages by FP-growth."""

from __future__ import annotations

from math import ceil

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starward.llm.common import text_column
from starward.sources.scratch import staged

#: Host and path of each given rule, and its verdict.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
#: A mined rule needs this part of the labelled pages, and at least so many, with its tokens and a bad label ...
SUPPORT, LEAST_PAGES = 0.01, 8
#: ... and this part of the pages with its tokens to be bad.
CONFIDENCE = 0.8
MOST_TOKENS = 3
BAD = "=bad"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What stands after the first ``://`` up to ``/ ? #``, its A-Z in lower case; what follows up to ``? #``.  Else both empty."""
    rest = F.when(F.locate("://", url) > 0, F.expr("substring(_url, locate('://', _url) + 3)")).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def url_tokens(host: Column, path: Column, url: Column) -> Column:
    """Distinct tokens of a URL: labels of the host, segments of the path with numbers as ``#``, names in the query."""
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1)

    def named(prefix: str, parts: Column) -> Column:
        return F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(prefix), x))

    segments = F.split(F.regexp_replace(path, "[0-9]+", "#"), "/")
    names = F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1))
    return F.array_sort(F.array_distinct(F.concat(named("h:", F.split(host, r"\.")), named("p:", segments), named("q:", names))))


def given_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule of the list that fits, and its verdict; a rule's host also stands for its subdomains."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, start, what in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        rule, verdict = F.when(fits, F.lit(name + start)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def mine(labelled: DataFrame) -> DataFrame:
    """``tokens, rule, confidence, support`` of rules for bad pages, from ``labelled (tokens, bad)``.

    FP-growth counts token sets together with the label.  Rules with too few pages or too little confidence
    go, and so do those with more than ``MOST_TOKENS`` tokens, or with at most the confidence of a rule with a part
    of their tokens.
    """
    n = labelled.count()
    least = max(LEAST_PAGES, ceil(SUPPORT * n))
    items = F.when(F.col("bad"), F.concat("tokens", F.array(F.lit(BAD)))).otherwise(F.col("tokens")).alias("items")
    growth = FPGrowth(itemsCol="items", minSupport=min(1.0, (least - 0.5) / max(n, 1)), minConfidence=CONFIDENCE)
    found = growth.fit(labelled.select(items)).associationRules if n >= least else None
    if found is None:
        return labelled.sparkSession.createDataFrame([], "tokens array<string>, rule string, confidence double, support double")
    bad = found.where((F.element_at("consequent", 1) == BAD) & (F.size("antecedent") <= MOST_TOKENS))
    rules = staged(
        bad.select(F.array_sort("antecedent").alias("tokens"), "confidence", "support").withColumn("rule", F.array_join("tokens", " ")), "rules"
    )
    parts = F.expr(
        f"filter(transform(sequence(1, shiftleft(1, size(tokens)) - 2), m -> filter(tokens, (x, i) -> (m & shiftleft(1, i)) != 0)), x -> size(x) < {MOST_TOKENS})"
    )
    several = rules.where(F.size("tokens") > 1).select("rule", F.col("confidence").alias("own"), F.explode(parts).alias("part"))
    better = several.join(rules.select(F.col("tokens").alias("part"), "confidence"), "part").where("confidence >= own")
    return rules.join(better.select("rule").distinct(), "rule", "left_anti").select("tokens", "rule", "confidence", "support")


def matches(urls: DataFrame, rules: DataFrame, labelled: DataFrame) -> DataFrame:
    """``tokens, mined_rule``: the most confident rule for each distinct token set of ``urls (tokens)`` that has one.

    The index has each rule once, under its rarest token, so a common token such as a third of all
    hosts leads to few rules; a candidate's other tokens are then compared.
    """
    often = labelled.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    spread = rules.select("*", F.explode("tokens").alias("token")).join(often, "token", "left")
    index = spread.groupBy("rule", "tokens", "confidence", "support").agg(F.min(F.struct("n", "token")).alias("rarest"))
    index = index.select(F.col("rarest.token").alias("token"), F.col("tokens").alias("needed"), "rule", "confidence", "support")
    asked = urls.select("tokens").distinct().select("tokens", F.explode("tokens").alias("token"))
    hit = asked.join(index, "token").where(F.size(F.array_except("needed", "tokens")) == 0)
    best = F.max(F.struct("confidence", "support", "rule")).alias("best")
    return hit.groupBy("tokens").agg(best).select("tokens", F.col("best.rule").alias("mined_rule"))


def judge_urls(pages: DataFrame, labels: DataFrame, page_id: str = "page_id", url: str = "url", label_id: str = "doc_id") -> DataFrame:
    """``page_id, host, path, rule, verdict, mined_rule``, a row for each page.

    The longest given rule that fits decides; other pages are blocked if a mined rule fits, else allowed.  A page
    is labelled if its id is in ``labels``, and bad if one of its labels says toxic or of no quality.

    Null urls and those without ``://`` have an empty host and path, fit no given rule and are allowed.  Null ids and
    repeated rows stay, each with its row; repeated rows weigh as often as they stand there.  Null labels say nothing.  Empty tables give no
    rows or no mined rules.  Further columns are ignored.
    """
    rows = pages.select(text_column(pages, page_id).alias("page_id"), text_column(pages, url).alias("_url"))
    host, path = host_and_path(F.col("_url"))
    rows = rows.withColumns({"host": host, "path": path})
    rule, verdict = given_rule(F.col("host"), F.col("path"))
    rows = staged(
        rows.withColumns({"rule": rule, "given": verdict, "tokens": url_tokens(F.col("host"), F.col("path"), F.col("_url"))}).drop("_url"), "urls"
    )
    bad = (F.coalesce(text_column(labels, "toxic") == 1, F.lit(False))) | (F.coalesce(text_column(labels, "quality") == 0, F.lit(False)))
    said = labels.select(text_column(labels, label_id).alias("page_id"), bad.alias("bad")).groupBy("page_id").agg(F.max("bad").alias("bad"))
    labelled = staged(rows.where(F.size("tokens") > 0).join(said, "page_id").select("tokens", "bad"), "labelled")
    mined = matches(rows, mine(labelled), labelled)
    judged = F.coalesce("given", F.when(F.col("mined_rule").isNotNull(), "block").otherwise("allow")).alias("verdict")
    return rows.join(mined, "tokens", "left").select("page_id", "host", "path", "rule", judged, "mined_rule")


def judge_sql() -> str:
    """The same in SQL; token sets are listed outright, up to ``MOST_TOKENS``."""
    fits = [
        (n + p, v, f"(host = '{n}' OR ends_with(host, '.{n}')) AND starts_with(path, '{p}')")
        for n, p, v in sorted(RULES, key=lambda r: -len(r[0] + r[1]))
    ]
    rule = " ".join(f"WHEN {c} THEN '{r}'" for r, _, c in fits)
    given = " ".join(f"WHEN {c} THEN '{v}'" for _, v, c in fits)
    return rf"""
WITH cut AS (
  SELECT page_id, coalesce(url, '') AS url,
         CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, url,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
urls AS (
  SELECT page_id, host, path, CASE {rule} END AS rule, CASE {given} END AS given,
         list_sort(list_distinct(
           [concat('h:', x) FOR x IN string_split(host, '.') IF x <> '']
           || [concat('p:', x) FOR x IN string_split(regexp_replace(path, '[0-9]+', '#', 'g'), '/') IF x <> '']
           || [concat('q:', string_split(x, '=')[1]) FOR x IN string_split(regexp_extract(url, '\?([^#]*)', 1), '&') IF string_split(x, '=')[1] <> '']
         )) AS tokens FROM parts),
said AS (
  SELECT doc_id, bool_or(coalesce(toxic = 1, false) OR coalesce(quality = 0, false)) AS bad FROM labels GROUP BY doc_id),
labelled AS (
  SELECT row_number() OVER () AS r, tokens, bad FROM urls JOIN said ON page_id = doc_id WHERE len(tokens) > 0),
one AS (SELECT r, bad, unnest(tokens) AS t FROM labelled),
sets AS (
  SELECT r, bad, [t] AS s FROM one
  UNION ALL SELECT a.r, a.bad, [a.t, b.t] FROM one a JOIN one b ON a.r = b.r AND a.t < b.t
  UNION ALL SELECT a.r, a.bad, [a.t, b.t, c.t] FROM one a JOIN one b ON a.r = b.r AND a.t < b.t JOIN one c ON a.r = c.r AND b.t < c.t),
rules AS (
  SELECT s, count(*) FILTER (bad) AS bads, count(*) FILTER (bad) / count(*) AS confidence FROM sets GROUP BY s
  HAVING count(*) FILTER (bad) >= greatest({LEAST_PAGES}, (SELECT ceil({SUPPORT} * count(*)) FROM labelled))
     AND count(*) FILTER (bad) / count(*) >= {CONFIDENCE}),
pruned AS (
  SELECT * FROM rules a WHERE NOT EXISTS (
    SELECT 1 FROM rules b WHERE len(b.s) < len(a.s) AND list_has_all(a.s, b.s) AND b.confidence >= a.confidence)),
best AS (
  SELECT u.tokens, array_to_string(p.s, ' ') AS mined_rule,
         row_number() OVER (PARTITION BY u.tokens ORDER BY confidence DESC, bads DESC, array_to_string(p.s, ' ') DESC) AS n
  FROM (SELECT DISTINCT tokens FROM urls) u JOIN pruned p ON list_has_all(u.tokens, p.s))
SELECT page_id, host, path, rule,
       coalesce(given, CASE WHEN mined_rule IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict, mined_rule
FROM urls LEFT JOIN best ON urls.tokens = best.tokens AND n = 1"""

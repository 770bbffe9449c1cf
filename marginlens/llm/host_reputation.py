"""URL filters by empirical-Bayes host reputation (DataFrame functions only).

A url's verdict is that of the longest rule that fits it; without one it is
the verdict of its host's reputation:

1. A labelled page has an outcome, good or bad. Outcomes are counted by host,
   by registered domain and by public suffix (map-side combine throughout).
2. Every level has a beta prior centred on the level above: suffixes on the
   whole corpus, domains on their suffix, hosts on their domain. The prior's
   strength is the level's own beta-binomial moment estimate: with ``k`` good
   of ``n`` labelled pages, ``k(k-1) / n(n-1)`` is unbiased for the squared
   rate, so the spread of the true rates around the parent is estimated
   without the sampling noise of small hosts.
3. A host's posterior is a beta distribution. The host is blocked when the
   upper bound of its share of good pages is below ``MIN_GOOD``, that is when
   even the favourable end of the evidence speaks against it; hosts with
   little evidence stay near their domain and are allowed.

The estimates use integer sums of scaled terms, so they do not depend on the
order of rows. What reaches the driver are two integers per level.

A host may hold a third of all pages: it is counted with partial aggregates,
and its reputation comes back by a broadcast of the hosts above ``SUPPORT`` of
the pages (at most ``1 / SUPPORT`` rows at any size); all other hosts take an
ordinary join.

The given tables label documents; a page has the outcome of the label row with
its id (``page_id = doc_id``): good when ``quality`` is 1 and ``toxic`` is not.

Defined cases: a null url or one without ``://`` has an empty host and path,
which is judged like any other host; several label rows of an id count as one
outcome, good only if all are; rows repeating ``(page_id, host)`` are one
labelled page; label rows without quality and toxicity are none; a null
``page_id`` is never labelled; without labels every host is allowed; an empty
table gives an empty result; equally long rules: the first by text, block
before allow.
"""
from __future__ import annotations

import math
import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marginlens.llm.common import driver_table, staged

#: Rules of the contract: (action, host, path prefix).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Public suffixes of two labels, as fixed values; any other suffix is the last label.
SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "co.jp", "com.br", "co.in", "co.nz", "co.za")

MIN_GOOD = 0.5
#: Normal quantile of the one-sided 95 % bound.
Z = 1.645
#: Limits of a prior's strength, in pages.
WEAKEST, STRONGEST = 1.0, 1000.0
#: Share of the rows from which a key is joined map-side; bounds that broadcast to 1/SUPPORT rows.
SUPPORT = 0.002
SCALE = 1e9


def lowered(c) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def url_host(url: str) -> Column:
    return lowered(F.regexp_extract(_rest(url), r"^[^/?#]*", 0))


def url_path(url: str) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: str) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.locate("://", F.col(url))
    return F.when(at > 0, F.substr(F.col(url), at + 3)).otherwise(F.lit(""))


def rule_order(rules: Sequence[tuple[str, str, str]]) -> list[tuple[str, str, str]]:
    return sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2], r[0] != "block"))


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """``struct(rule, action)`` of the longest rule that fits, else null.

    A rule list is configuration: it is compiled into one expression.
    """
    out = F.lit(None).cast("struct<rule:string,action:string>")
    for action, rule_host, prefix in reversed(rule_order(rules)):
        fits = (host == rule_host) | host.endswith("." + rule_host)
        found = F.struct(F.lit(rule_host + prefix).alias("rule"), F.lit(action).alias("action"))
        out = F.when(fits & path.startswith(prefix), found).otherwise(out)
    return out


def registered(host: Column, suffixes: Sequence[str] = SUFFIXES) -> Column:
    """``struct(domain, suffix)`` of a host.

    User names and ports are no part of it. An address of digits, and a host
    that is only a suffix, is its own domain.
    """
    name = F.regexp_replace(host, r"^.*@|:[0-9]*$", "")
    labels = F.split(name, r"\.")
    n = F.size(labels)
    two = F.array_join(F.slice(labels, F.greatest(n - 1, F.lit(1)), 2), ".")
    long = (n >= 2) & two.isin(*suffixes) if suffixes else F.lit(False)
    width = F.when(long, F.lit(2)).otherwise(F.lit(1))

    def last(k):
        return F.array_join(F.slice(labels, F.greatest(n - k + 1, F.lit(1)), k), ".")

    digits = name.rlike(r"^[0-9.]+$")
    return F.struct(F.when(digits, name).otherwise(last(width + 1)).alias("domain"),
                    F.when(digits, F.lit("")).otherwise(last(width)).alias("suffix"))


def join_split(rows: DataFrame, lookup: DataFrame, key: str, weight: str, support: float = SUPPORT) -> DataFrame:
    """``rows`` with the columns of ``lookup`` (one row per key; ``weight`` = rows of the key).

    Keys above ``support`` of the weight are joined map-side -- at most
    ``1 / support`` of them -- and the others by an ordinary join.
    """
    total = lookup.agg(F.sum(weight)).first()[0] or 0
    hot = F.broadcast(staged(lookup.filter(F.col(weight) > F.lit(support * total)), "hot_keys"))
    rest = rows.join(hot.select(key), key, "left_anti").join(lookup, key)
    return rows.join(hot, key).unionByName(rest).drop(weight)


def page_outcomes(labels: DataFrame) -> DataFrame:
    """``page_id, good`` (1 or 0): one outcome per labelled id."""
    good = F.when(F.col("toxic") == 1, F.lit(0)).when(F.col("quality").isNotNull(), (F.col("quality") == 1).cast("int"))
    return (labels.select(F.col("doc_id").alias("page_id"), good.alias("good")).filter(F.col("good").isNotNull())
            .groupBy("page_id").agg(F.min("good").alias("good")))


def _strength(groups: DataFrame) -> float:
    """A level's prior strength from groups ``n, k, centre`` (moment estimate)."""
    n, k, c = F.col("n").cast("double"), F.col("k").cast("double"), F.col("centre")
    around = (k * (k - 1)) / (n * (n - 1)) - 2 * c * (k / n) + c * c

    def total(x):
        return F.sum(F.floor(x * SCALE))

    got = groups.filter("n >= 2").agg(total(around).alias("d"), total(c * (1 - c)).alias("v")).first()
    if got.d is None or got.d <= 0:
        return STRONGEST
    return min(STRONGEST, max(WEAKEST, float(got.v) / float(got.d) - 1.0))


def _posterior(groups: DataFrame, strength: float) -> DataFrame:
    """``groups`` with ``a, b, mean`` of the beta posterior."""
    s, n, k, c = F.lit(strength), F.col("n").cast("double"), F.col("k").cast("double"), F.col("centre")
    return (groups.withColumns({"a": s * c + k, "b": s * (1 - c) + (n - k)})
            .withColumn("mean", F.col("a") / (F.col("a") + F.col("b"))))


def host_reputation(pages: DataFrame, outcomes: DataFrame) -> DataFrame:
    """One row per host of ``pages (page_id, host)``: ``host, domain, suffix,
    n_pages, n, k, mean, upper, blocked``."""
    pairs = pages.groupBy("page_id", "host").agg(F.count(F.lit(1)).alias("n_pages"))
    hosts = (pairs.join(outcomes, "page_id", "left").groupBy("host")
             .agg(F.sum("n_pages").alias("n_pages"), F.count("good").alias("n"),
                  F.coalesce(F.sum("good"), F.lit(0)).alias("k")))
    hosts = staged(hosts.select("*", registered(F.col("host")).alias("r")).select("*", "r.domain", "r.suffix").drop("r"), "hosts")

    def level(below, key, *more):
        return staged(below.groupBy(key, *more).agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("n"),
                                                    F.sum("k").alias("k")), key)

    domains = level(hosts, "domain", "suffix")
    suffixes = level(domains, "suffix")
    n, k = suffixes.agg(F.sum("n"), F.sum("k")).first()
    corpus = ((k or 0) + 1.0) / ((n or 0) + 2.0)

    def shrunk(groups):
        return _posterior(groups, _strength(groups))

    def under(groups, parents, key):
        """The groups with their parent's mean as their prior's centre."""
        centres = parents.select(key, F.col("members").alias("_weight"), F.col("mean").alias("centre"))
        return staged(join_split(groups, centres, key, "_weight"), f"{key}_centres")

    suffixes = staged(shrunk(suffixes.withColumn("centre", F.lit(corpus))), "suffix_rates")
    domains = staged(shrunk(under(domains, suffixes, "suffix")), "domain_rates")
    hosts = shrunk(under(hosts, domains, "domain"))
    a, b, both = F.col("a"), F.col("b"), F.col("a") + F.col("b")
    upper = F.col("mean") + F.lit(Z) * F.sqrt((a * b) / (both * both * (both + 1)))
    return hosts.select("host", "domain", "suffix", "n_pages", "n", "k", "mean", upper.alias("upper"),
                        (upper < MIN_GOOD).alias("blocked"))


def judge_urls(pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict``."""
    urls = pages.select("page_id", url_host("url").alias("host"), url_path("url").alias("path"))
    known = staged(host_reputation(urls.select("page_id", "host"), page_outcomes(labels)), "host_reputation")
    judged = join_split(urls, known.select("host", "n_pages", "blocked"), "host", "n_pages")
    return (judged.withColumn("_fit", fitting_rule(F.col("host"), F.col("path"), rules))
            .select("page_id", "host", "path", "_fit.rule",
                    F.coalesce(F.col("_fit.action"), F.when(F.col("blocked"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict")))


def op13_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(driver_table(spark, sf_dir, "pages"), driver_table(spark, sf_dir, "labels"))


def _sql() -> str:
    upper, lower = string.ascii_uppercase, string.ascii_lowercase
    rules = ", ".join(f"('{a}', '{h}', '{p}')" for a, h, p in RULES)
    two = ", ".join(f"'{s}'" for s in SUFFIXES)

    def strength(groups):
        return f"""(
  SELECT CASE WHEN d IS NULL OR d <= 0 THEN {STRONGEST}::DOUBLE
              ELSE least({STRONGEST}::DOUBLE, greatest({WEAKEST}::DOUBLE, v::DOUBLE / d::DOUBLE - 1::DOUBLE)) END
  FROM (SELECT sum(floor(((k::DOUBLE * (k::DOUBLE - 1)) / (n::DOUBLE * (n::DOUBLE - 1))
                          - 2::DOUBLE * centre * (k::DOUBLE / n::DOUBLE) + centre * centre) * {SCALE:.0f}::DOUBLE)::BIGINT) AS d,
               sum(floor((centre * (1::DOUBLE - centre)) * {SCALE:.0f}::DOUBLE)::BIGINT) AS v
        FROM {groups} WHERE n >= 2))"""

    def posterior(groups):
        return f"""
  SELECT *, a / (a + b) AS mean FROM (
    SELECT g.*, s * centre + k::DOUBLE AS a, s * (1::DOUBLE - centre) + (n::DOUBLE - k::DOUBLE) AS b
    FROM {groups} g, (SELECT {strength(groups)} AS s))"""

    return f"""
WITH p AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), u AS (
  SELECT row_number() OVER () AS i, page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{upper}', '{lower}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p
), r AS (
  SELECT * FROM (VALUES {rules}) AS t(action, rule_host, prefix)
), fit AS (
  SELECT i, rule_host || prefix AS rule, action,
         row_number() OVER (PARTITION BY i ORDER BY length(rule_host || prefix) DESC, rule_host || prefix, action DESC) AS rn
  FROM u JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, prefix)
), o AS (
  SELECT doc_id AS page_id, min(good) AS good
  FROM (SELECT doc_id, CASE WHEN toxic = 1 THEN 0 WHEN quality IS NOT NULL THEN (quality = 1)::INT END AS good FROM labels)
  WHERE good IS NOT NULL GROUP BY doc_id
), h0 AS (
  SELECT host, count(good) AS n, coalesce(sum(good), 0) AS k
  FROM (SELECT DISTINCT page_id, host FROM u) LEFT JOIN o USING (page_id) GROUP BY host
), h1 AS (
  SELECT *, string_split(name, '.') AS w FROM (
    SELECT *, regexp_replace(host, '^.*@|:[0-9]*$', '', 'g') AS name FROM h0)
), h2 AS (
  SELECT *, CASE WHEN len(w) >= 2 AND array_to_string(w[-2:], '.') IN ({two}) THEN 2 ELSE 1 END AS width FROM h1
), h AS (
  SELECT host, n, k,
         CASE WHEN regexp_matches(name, '^[0-9.]+$') THEN name ELSE array_to_string(w[-(width + 1):], '.') END AS domain,
         CASE WHEN regexp_matches(name, '^[0-9.]+$') THEN '' ELSE array_to_string(w[-width:], '.') END AS suffix
  FROM h2
), d0 AS (
  SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM h GROUP BY ALL
), s0 AS (
  SELECT suffix, sum(n) AS n, sum(k) AS k,
         (coalesce(sum(sum(k)) OVER (), 0) + 1)::DOUBLE / (coalesce(sum(sum(n)) OVER (), 0) + 2)::DOUBLE AS centre
  FROM d0 GROUP BY suffix
), s1 AS ({posterior('s0')}
), d1 AS (
  SELECT d0.*, s1.mean AS centre FROM d0 JOIN s1 USING (suffix)
), d2 AS ({posterior('d1')}
), h3 AS (
  SELECT h.*, d2.mean AS centre FROM h JOIN d2 USING (domain)
), h4 AS ({posterior('h3')}
), v AS (
  SELECT host, mean + {Z}::DOUBLE * sqrt((a * b) / ((a + b) * (a + b) * (a + b + 1::DOUBLE))) < {MIN_GOOD}::DOUBLE AS blocked FROM h4
)
SELECT page_id, host, path, rule,
       coalesce(action, CASE WHEN blocked THEN 'block' ELSE 'allow' END) AS verdict
FROM u LEFT JOIN (SELECT * FROM fit WHERE rn = 1) USING (i) JOIN v USING (host)
"""


SQL = _sql()

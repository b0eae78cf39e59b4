"""URL verdicts: host and path rules first, then a host reputation learned from labelled pages.

DataFrame functions only.  A page's host is what follows the first ``://`` up to ``/``, ``?``,
``#`` or the end, with A-Z lower-cased; its path follows up to ``?``, ``#`` or the end.  A null
URL or one without ``://`` has an empty host and path.

Rules are ``(verdict, host, path)``.  A rule fits a page when the page's host is the rule's host
or one of its subdomains and the page's path starts with the rule's path.  Of the rules that
fit, the longest (``host + path``) decides; equal lengths go to the smaller rule text.

Pages no rule fits are judged by an empirical-Bayes reputation of their host.  Labelled
outcomes (a page is bad or not) are counted per host, per registered domain (the last two
labels of the host) and per suffix (the last label).  Rates shrink from the top down: the
suffix's toward the overall rate, the domain's toward its suffix's, the host's toward its
domain's, each through a beta prior whose strength is estimated from how much the rates of that
level vary beyond binomial noise (method of moments on the beta-binomial).  A host is blocked
when the lower bound of its posterior bad rate (mean minus ``z`` standard deviations of the beta
posterior) reaches ``threshold``; hosts without labels take their domain's prior and are judged
the same way.  Without any labelled outcome every such page is allowed.

Odd rows: a null URL, an empty table, repeated rows and extra input columns are fine; only
the ID and URL columns are read and the output has its own names.  Labels with a null outcome
are left out; repeated label rows count once each, a page ID with several hosts labels each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from compdict.checkpoints import cut
from compdict.llm.common import ascii_lower

# --- fixed values: the contract's rules (verdict, host, path), in its order
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
Z = 1.645
THRESHOLD = 0.5
# Bounds of an estimated prior strength: the estimate itself, kept finite and positive.
KAPPA_LOW, KAPPA_HIGH = 1.0, 10_000.0


def split_url(df: DataFrame, url_column: str) -> DataFrame:
    """Adds ``host`` and ``path`` (both empty for a null URL or one without ``://``)."""
    url = F.coalesce(F.col(url_column), F.lit(""))
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    return df.withColumn("host", ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0))).withColumn(
        "path", F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    )


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """``(rule text, verdict)`` of the longest fitting rule, or nulls."""
    ranked = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule_host, rule_path in reversed(ranked):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        text = F.when(fits, F.lit(rule_host + rule_path)).otherwise(text)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return text, verdict


def _levels(host: Column) -> tuple[Column, Column]:
    """Registered domain (last two labels) and suffix (last label) of a host."""
    parts = F.split(host, r"\.")
    domain = F.array_join(F.slice(parts, F.greatest(F.size(parts) - 1, F.lit(1)), 2), ".")
    return domain, F.element_at(parts, -1)


def _strength(units: DataFrame, mean: float) -> float:
    """Prior strength of one level from its units' ``(n, bad)``: ``m(1-m)/tau2 - 1``.

    ``tau2`` is the weighted variance of the units' rates less the binomial part.
    """
    row = units.agg(
        F.sum("n").alias("total"),
        F.count(F.lit(1)).alias("units"),
        F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n") - F.lit(mean), 2)).alias("spread"),
    ).first()
    if not row["total"]:
        return KAPPA_HIGH
    tau2 = row["spread"] / row["total"] - mean * (1 - mean) * row["units"] / row["total"]
    if tau2 <= 0:
        return KAPPA_HIGH
    return min(KAPPA_HIGH, max(KAPPA_LOW, mean * (1 - mean) / tau2 - 1))


def reputation(pages: DataFrame, outcomes: DataFrame, z: float = Z, threshold: float = THRESHOLD) -> DataFrame:
    """``(host, p_bad, bound, method_verdict)`` of every host of ``pages`` (columns ``host``).

    ``outcomes`` has ``host`` and ``bad`` (1 bad, 0 good, null left out).
    """
    labelled = outcomes.filter(F.col("bad").isNotNull())
    domain, suffix = _levels(F.col("host"))
    hosts = (
        labelled.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("bad").cast("long")).alias("bad"))
        .withColumn("domain", domain).withColumn("suffix", suffix)
    )
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    total = suffixes.agg(F.sum("n"), F.sum("bad")).first()
    p0 = (total[1] / total[0]) if total[0] else 0.0
    k_suffix, k_domain, k_host = _strength(suffixes, p0), _strength(domains, p0), _strength(hosts, p0)
    p_suffix = suffixes.select(
        "suffix", ((F.col("bad") + k_suffix * p0) / (F.col("n") + k_suffix)).alias("p_suffix")
    )
    p_domain = domains.join(p_suffix, "suffix").select(
        "domain", ((F.col("bad") + k_domain * F.col("p_suffix")) / (F.col("n") + k_domain)).alias("p_domain")
    )
    every = pages.select("host").distinct().withColumn("domain", domain).withColumn("suffix", suffix)
    prior_suffix = F.coalesce("p_suffix", F.lit(p0))
    prior = F.coalesce("p_domain", prior_suffix)
    joined = (
        every.join(p_suffix, "suffix", "left").join(p_domain, "domain", "left")
        .join(hosts.select("host", F.col("n").alias("h_n"), F.col("bad").alias("h_bad")), "host", "left")
        .withColumn("_prior", prior)
    )
    a = F.coalesce("h_bad", F.lit(0)) + F.lit(k_host) * F.col("_prior")
    b = F.coalesce(F.col("h_n") - F.col("h_bad"), F.lit(0)) + F.lit(k_host) * (1 - F.col("_prior"))
    mean = a / (a + b)
    sd = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return joined.select(
        "host", mean.alias("p_bad"), (mean - F.lit(z) * sd).alias("bound"),
    ).withColumn("method_verdict", F.when(F.col("bound") >= threshold, "block").otherwise("allow"))


def judge(
    pages: DataFrame, outcomes: DataFrame, id_column: str = "page_id", url_column: str = "url",
    rules=RULES, z: float = Z, threshold: float = THRESHOLD, broadcast_hosts: int = 1_000_000,
) -> DataFrame:
    """One row per page: ID, ``host``, ``path``, ``rule`` (null if none fits), ``verdict``.

    ``outcomes``: ``(id, bad)`` rows of labelled pages, matched to ``pages`` by ID.  Host
    verdicts join the pages by host; they are broadcast when there are at most
    ``broadcast_hosts`` hosts, else joined by a shuffle (a hot host is then split by the
    skew-join rule, as its side has one row per host).
    """
    split = split_url(pages.select(F.col(id_column).alias("_id"), F.col(url_column).alias("_url")), "_url")
    labelled = (
        split.select("_id", "host").distinct().join(outcomes.select(F.col(id_column).alias("_id"), "bad"), "_id")
        .select("host", "bad")
    )
    hosts = cut(reputation(split, labelled, z, threshold).select("host", "method_verdict"))
    if hosts.count() <= broadcast_hosts:
        hosts = F.broadcast(hosts)
    text, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return split.join(hosts, "host", "left").select(
        F.col("_id").alias(id_column), "host", "path", text.alias("rule"),
        F.coalesce(verdict, "method_verdict", F.lit("allow")).alias("verdict"),
    )


def judge_sql(rules=RULES, z: float = Z, threshold: float = THRESHOLD) -> str:
    """The same in DuckDB SQL over ``pages`` and ``labels`` (bad: quality 0)."""
    ranked = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    fits = [f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')" for _, h, p in ranked]
    rule = " ".join(f"WHEN {f} THEN '{h}{p}'" for f, (_, h, p) in zip(fits, ranked))
    verdict = " ".join(f"WHEN {f} THEN '{v}'" for f, (v, _, _) in zip(fits, ranked))
    low = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    domain = "array_to_string(list_slice(string_split(host, '.'), greatest(len(string_split(host, '.')) - 1, 1), len(string_split(host, '.'))), '.')"
    suffix = "list_extract(string_split(host, '.'), -1)"

    def strength(table: str) -> str:
        m = "max(p0)"
        tau2 = f"(sum(n * pow(bad / n - p0, 2)) / sum(n) - {m} * (1 - {m}) * count(*) / sum(n))"
        return f"""(SELECT CASE WHEN coalesce(sum(n), 0) = 0 OR {tau2} <= 0 THEN {KAPPA_HIGH}
            ELSE least({KAPPA_HIGH}, greatest({KAPPA_LOW}, {m} * (1 - {m}) / {tau2} - 1)) END FROM {table}, t)"""

    return f"""
WITH p AS (SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
s AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), {low}) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
lab AS (SELECT s.host, CAST(l.quality = 0 AS INTEGER) AS bad FROM (SELECT DISTINCT page_id, host FROM s) s JOIN labels l ON s.page_id = l.doc_id WHERE l.quality IS NOT NULL),
h AS (SELECT host, count(*) AS n, sum(bad) AS bad, {domain} AS domain, {suffix} AS suffix FROM lab GROUP BY host),
d AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM h GROUP BY domain, suffix),
x AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM d GROUP BY suffix),
t AS (SELECT CASE WHEN coalesce(sum(n), 0) = 0 THEN 0.0 ELSE sum(bad) / sum(n) END AS p0 FROM x),
kk AS (SELECT {strength('x')} AS kx, {strength('d')} AS kd, {strength('h')} AS kh),
ps AS (SELECT suffix, (bad + kx * p0) / (n + kx) AS p_suffix FROM x, t, kk),
pd AS (SELECT d.domain, (d.bad + kd * ps.p_suffix) / (d.n + kd) AS p_domain FROM d JOIN ps USING (suffix), kk),
ev AS (SELECT DISTINCT host, {domain} AS domain, {suffix} AS suffix FROM s),
j AS (SELECT ev.host, coalesce(pd.p_domain, ps.p_suffix, t.p0) AS prior, h.n AS h_n, h.bad AS h_bad
      FROM ev LEFT JOIN ps ON ev.suffix = ps.suffix LEFT JOIN pd ON ev.domain = pd.domain LEFT JOIN h ON ev.host = h.host, t),
v AS (SELECT host, coalesce(h_bad, 0) + kh * prior AS a, coalesce(h_n - h_bad, 0) + kh * (1 - prior) AS b FROM j, kk),
hv AS (SELECT host, CASE WHEN a / (a + b) - {z} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) >= {threshold} THEN 'block' ELSE 'allow' END AS mv FROM v)
SELECT page_id, host, path, CASE {rule} END AS rule, coalesce(CASE {verdict} END, mv, 'allow') AS verdict
FROM s LEFT JOIN hv USING (host)
"""

"""Filtering of pages by rules and by the reputation of their hosts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import UPPER, store

# Rules as (verdict, host, path).
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)

# Suffixes of more than one label, given by the caller for a real crawl.
SUFFIXES: tuple[str, ...] = ()


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and ``/ ? #`` or the end; empty without it."""
    found = F.regexp_extract(url, r"^(?s)(?:.*?)://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, UPPER, UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``? #`` or the end."""
    found = F.regexp_extract(url, r"^(?s)(?:.*?)://[^/?#]*([^?#]*)", 1)
    return F.coalesce(found, F.lit(""))


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Struct of the rule text and verdict of the longest rule that fits, else NULL."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, name, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        fitting = F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, fitting).otherwise(out)
    return out


def _suffix(host: Column, suffixes: Sequence[str]) -> Column:
    out = F.element_at(F.split(host, r"\."), -1)
    for name in sorted(suffixes, key=len):
        out = F.when((host == name) | host.endswith("." + name), F.lit(name)).otherwise(out)
    return out


def _domain(host: Column, suffix: Column) -> Column:
    """One label more than the suffix, if there is one."""
    labels = F.size(F.split(suffix, r"\.")) + 1
    return F.call_function("substring_index", host, F.lit("."), -labels)


def _strength(level: DataFrame, parent: Column, limits: tuple[float, float]) -> Column:
    """Weight, in outcomes, of the parent's rate as a prior of its children, by moments.

    The spread of children's rates about their parent's, beyond that of chance, gives the
    correlation rho of outcomes within a child; the prior weighs ``1 / rho - 1`` outcomes.
    """
    per = level.groupBy(parent.alias("parent")).agg(
        F.sum("n").alias("n"),
        F.sum("bad").alias("bad"),
        F.sum(F.col("n") * F.col("n")).alias("n2"),
        F.sum(F.col("bad") * F.col("bad") / F.col("n")).alias("b2"),
        F.count("*").alias("m"),
    )
    rate = F.col("bad") / F.col("n")
    chance = rate * (1 - rate)
    free = F.col("m") - 1
    seen = F.col("b2") - F.col("bad") * rate
    per = per.agg(
        F.sum(seen - chance * free).alias("over"),
        F.sum(chance * (F.col("n") - F.col("n2") / F.col("n") - free)).alias("scale"),
    )
    rho = F.col("over") / F.nullif(F.col("scale"), F.lit(0.0))
    weight = F.when(rho > 0, 1 / rho - 1).otherwise(F.lit(limits[1]))
    weight = F.greatest(F.lit(limits[0]), F.least(weight, F.lit(limits[1])))
    return per.select(F.coalesce(weight, F.lit(limits[1]))).scalar()


def host_reputation(
    outcomes: DataFrame,
    suffixes: Sequence[str] = SUFFIXES,
    limits: tuple[float, float] = (1.0, 1000.0),
    z: float = 1.645,
) -> DataFrame:
    """Bad-rate of every host, shrunk towards its registered domain and its suffix.

    ``outcomes`` has ``host`` and ``bad`` (1 or 0; NULL where the page has no label), one row
    per page. Returns ``host, n, bad, mean, low``. The rate of all pages is the prior of a
    suffix, the posterior mean of a suffix that of its domains, and the posterior mean of a
    domain that of its hosts; ``low`` is the lower bound of the host's posterior. A host
    without labelled pages has its domain's mean; without any labels every rate is 0.

    The frames hold one row per host, domain or suffix, after map-side sums over pages; the
    hosts' counts are stored, as every level reads them.
    """
    hosts = outcomes.groupBy("host").agg(
        F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")
    )
    suffix = _suffix(F.col("host"), suffixes)
    hosts = hosts.withColumn("suffix", suffix)
    hosts = store(hosts.withColumn("domain", _domain(F.col("host"), F.col("suffix"))))
    domains = hosts.groupBy("domain", "suffix").agg(
        F.sum("n").alias("n"), F.sum("bad").alias("bad")
    )
    tops = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))

    labelled = F.col("n") > 0
    everything = tops.agg(
        F.coalesce(F.sum("bad") / F.nullif(F.sum("n"), F.lit(0)), F.lit(0.0))
    ).scalar()

    def shrunk(prior: Column, weight: Column) -> Column:
        return (F.col("bad") + prior * weight) / (F.col("n") + weight)

    weight = _strength(tops.where(labelled), F.lit(1), limits)
    tops = tops.select("suffix", shrunk(everything, weight).alias("suffix_mean"))
    weight = _strength(domains.where(labelled), F.col("suffix"), limits)
    domains = domains.join(tops, "suffix").select(
        "domain", shrunk(F.col("suffix_mean"), weight).alias("domain_mean")
    )
    weight = _strength(hosts.where(labelled), F.col("domain"), limits)
    hosts = hosts.join(domains, "domain").select(
        "host",
        "n",
        "bad",
        shrunk(F.col("domain_mean"), weight).alias("mean"),
        (F.col("n") + weight).alias("total"),
    )
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("total") + 1))
    low = F.greatest(F.lit(0.0), F.col("mean") - z * deviation)
    return hosts.select("host", "n", "bad", "mean", low.alias("low"))


def judge_pages(
    pages: DataFrame,
    labels: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    max_bad: float = 0.5,
    suffixes: Sequence[str] = SUFFIXES,
) -> DataFrame:
    """Verdict on every page, by the longest rule or else by its host's reputation.

    ``pages`` has ``page_id`` and ``url``; ``labels`` has ``doc_id, quality, toxic``. A page
    is labelled by the document whose number ends its path; it is bad if that document is of
    quality 0 or toxic. A host is blocked when even the lower bound of its bad rate is above
    ``max_bad``. Returns ``page_id, host, path, rule, verdict, bad_rate, bad_low``.

    A NULL url, or one without ``://``, has an empty host and path; such pages share the
    empty host's reputation. Labels that are NULL in both marks do not count; of several
    labels of one document the worst counts. Repeated pages count one by one, and pages
    without labels pass. Empty tables give no rows. Other columns are not read.
    """
    bad = F.greatest(1 - F.col("quality"), F.col("toxic"))
    marks = labels.groupBy(F.col("doc_id").cast("string").alias("number")).agg(
        F.max(bad).alias("bad")
    )
    marks = marks.where(F.col("number").isNotNull() & F.col("bad").isNotNull())
    pages = pages.select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    number = F.nullif(F.regexp_extract("path", r"/(\d+)(?:\.html)?/?$", 1), F.lit(""))
    outcomes = pages.select("host", number.alias("number"))
    outcomes = outcomes.join(marks, "number", "left").select("host", "bad")
    reputation = host_reputation(outcomes, suffixes).select("host", "mean", "low")
    rule = longest_rule(F.col("host"), F.col("path"), rules)
    judged = pages.join(reputation, "host", "left").withColumn("fit", rule)
    verdict = F.when(F.col("low") > max_bad, F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(
        "page_id",
        "host",
        "path",
        F.col("fit.rule").alias("rule"),
        F.coalesce("fit.verdict", verdict).alias("verdict"),
        F.col("mean").alias("bad_rate"),
        F.col("low").alias("bad_low"),
    )

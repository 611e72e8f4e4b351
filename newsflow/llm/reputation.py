"""URL filter by empirical-Bayes host reputation, in DataFrame operations only.

Outcomes are pages with a known verdict (good or bad). Bad pages are counted per host, registered domain and
suffix. Each level's share of bad pages is shrunk towards the level above by a beta-binomial prior: its mean is
the shrunk share of the parent, its strength is estimated from all groups of the level by the method of moments,
so levels whose members differ little shrink more. A host is blocked when the lower bound of its posterior
share (mean minus ``z`` standard deviations) is above ``limit``, that is, only when its record proves it.

Without a list of public suffixes the suffix is the last label of a host and the registered domain its last two.

Counts are partial aggregates; hosts, domains and suffixes are joined by key on counts, never on pages. Pages of
a host with a large share of all rows are salted where they meet the host's verdict.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.operators.skew import lookup_join

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: (rule host, path, verdict): fixed rules; the longest that fits wins.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
STRENGTHS = (1.0, 1000.0)
LIMIT = 0.5
Z = 1.645


def url_host(url: Column) -> Column:
    """What stands behind the first ``://`` up to ``/``, ``?`` or ``#``, A-Z lower-cased; empty without ``://``."""
    host = F.regexp_extract(url, r"://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, UPPER.lower()), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def registered_domain(host: Column) -> Column:
    return F.substring_index(host, ".", -2)


def with_rule(pages: DataFrame, rules=RULES) -> DataFrame:
    """Add ``rule`` and ``rule_verdict`` of the longest rule that fits ``host`` and ``path``, else null."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, path, outcome in sorted(rules, key=lambda r: len(r[0] + r[1])):
        host = F.col("host")
        fits = ((host == name) | host.endswith("." + name)) & F.col("path").startswith(path)
        rule = F.when(fits, F.lit(name + path)).otherwise(rule)
        verdict = F.when(fits, F.lit(outcome)).otherwise(verdict)
    return pages.withColumns({"rule": rule, "rule_verdict": verdict})


def _strength(groups: DataFrame, prior: str) -> DataFrame:
    """One row with ``strength`` of the beta-binomial prior of a level, from ``n``, ``bad`` and each group's prior mean.

    Moments: between groups, ``sum n (p - m)^2`` expects ``sum m (1-m) (1 + (n - 1) r)`` with ``r = 1 / (strength + 1)``.
    A level without a group of two outcomes says nothing and gets the greatest strength.
    """
    low, high = STRENGTHS
    m, n = F.col(prior), F.col("n")
    spread = F.sum(n * F.pow(F.col("bad") / n - m, 2))
    base, excess = F.sum(m * (1 - m)), F.sum(m * (1 - m) * (n - 1))
    r = F.try_divide(spread - base, excess)
    strength = F.when(r > 0, F.greatest(F.least(1 / r - 1, F.lit(high)), F.lit(low))).otherwise(F.lit(high))
    return groups.where(n > 0).agg(strength.alias("strength"))


def _shrunk(groups: DataFrame, prior: str, prior_weight: str, mean: str, weight: str) -> DataFrame:
    """Add the posterior mean of each group and its weight (outcomes plus prior strength), given those of the parent.

    A prior is never stronger than the evidence behind the parent's mean. The strength is a scalar subquery.
    """
    k = F.least(_strength(groups, prior).scalar(), prior_weight)
    return groups.withColumn("_k", k).withColumns(
        {
            mean: (F.col("bad") + F.col("_k") * F.col(prior)) / (F.col("n") + F.col("_k")),
            weight: F.col("n") + F.col("_k"),
        }
    ).drop("_k")


def host_reputation(hosts: DataFrame, z: float = Z, limit: float = LIMIT) -> DataFrame:
    """``host, n, bad, mean, bound, blocked`` for each host of ``hosts(host, n, bad)``, unique by host.

    ``n`` counts a host's outcomes, ``bad`` the bad ones; hosts without outcomes (0, 0) are judged by their domain.
    The overall share counts one good and one bad page more than seen, so that it exists without any outcome.
    """
    placed = hosts.select(
        "host", "n", "bad", registered_domain(F.col("host")).alias("domain"), suffix(F.col("host")).alias("suffix")
    )
    domains = placed.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    n, bad = F.coalesce(F.sum("n"), F.lit(0)) + 2, F.coalesce(F.sum("bad"), F.lit(0)) + 1
    overall = suffixes.agg(F.struct((bad / n).alias("mean"), n.cast("double").alias("weight"))).scalar()
    suffixes = suffixes.withColumn("_all", overall).select(
        "*", F.col("_all.mean").alias("all_mean"), F.col("_all.weight").alias("all_weight")
    )
    suffixes = _shrunk(suffixes, "all_mean", "all_weight", "suffix_mean", "suffix_weight")
    domains = domains.join(suffixes.select("suffix", "suffix_mean", "suffix_weight"), "suffix")
    domains = _shrunk(domains, "suffix_mean", "suffix_weight", "domain_mean", "domain_weight")
    found = placed.join(domains.select("domain", "domain_mean", "domain_weight"), "domain")
    found = _shrunk(found, "domain_mean", "domain_weight", "mean", "weight")
    bound = F.col("mean") - z * F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("weight") + 1))
    return found.select("host", "n", "bad", "mean", bound.alias("bound"), (bound > limit).alias("blocked"))


def judge(
    pages: DataFrame,
    outcomes: DataFrame | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    rules=RULES,
    z: float = Z,
    limit: float = LIMIT,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, n_outcomes, mean_bad, bound_bad`` for every row of ``pages``.

    A page that a rule fits gets the rule's verdict; the others are blocked or allowed by their host's posterior.
    ``outcomes(host, bad)`` are labelled pages, ``bad`` 0 or 1 (rows with a null are no outcomes); without them
    the pages that rules decide are the labelled ones. A null url, or one without ``://``, has an empty host and
    path; the empty host is a host like any other. Repeated and null ids keep their rows; other columns are not read.
    """
    placed = pages.select(
        F.col(id_col).alias("page_id"), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path")
    )
    placed = with_rule(placed, rules)
    if outcomes is None:
        known = placed.select("host", F.when(F.col("rule_verdict") == "block", 1).when(F.col("rule").isNotNull(), 0).alias("bad"))
    else:
        seen = outcomes.select("host", F.col("bad").cast("int").alias("bad")).where("bad is not null")
        known = placed.select("host", F.lit(None).cast("int").alias("bad")).unionByName(seen)
    hosts = known.where("host is not null").groupBy("host").agg(
        F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"), F.count(F.lit(1)).alias("_n")
    )
    found = host_reputation(hosts, z, limit).withColumnRenamed("n", "n_outcomes").withColumnsRenamed({"mean": "mean_bad", "bound": "bound_bad"})
    joined = lookup_join(
        placed, found.select("host", "n_outcomes", "mean_bad", "bound_bad", "blocked"), "host", "page_id", counts=hosts.select("host", "_n")
    )
    verdict = F.coalesce("rule_verdict", F.when(F.col("blocked"), "block").otherwise("allow"))
    return joined.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "n_outcomes", "mean_bad", "bound_bad")

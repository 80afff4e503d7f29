"""Host reputation by empirical Bayes, and verdicts on urls.

Labelled outcomes are counted per suffix, registered domain and host. Each level's share of good
pages is a beta posterior whose prior is its parent's mean, worth ``strength`` pages; the strength
comes from the spread of the shares between registered domains. A url is blocked if the upper
bound of its host's share of good pages lies below ``least_good``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cotag.functions.joins import held

# The rules of the contract as (host and path, verdict).
RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)
# Suffixes of several labels under which owners register names of their own. A fuller
# list is a parameter; a last label that is in no suffix of the list is a suffix.
PUBLIC_SUFFIXES = (
    "ac.jp", "ac.uk", "co.il", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.ar", "com.au",
    "com.br", "com.cn", "com.hk", "com.mx", "com.pl", "com.sg", "com.tr", "com.tw", "com.ua", "edu.au",
    "edu.cn", "gov.au", "gov.cn", "gov.uk", "ne.jp", "net.au", "net.br", "net.cn", "nhs.uk", "or.jp",
    "or.kr", "org.au", "org.br", "org.cn", "org.nz", "org.uk", "sch.uk", "appspot.com", "blogspot.com",
    "cloudfront.net", "github.io", "gitlab.io", "herokuapp.com", "netlify.app", "pages.dev",
    "s3.amazonaws.com", "vercel.app", "web.app", "wordpress.com",
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Standard deviations of the posterior between its mean and the bound.
BOUND_SD = 2.0
#: A host whose share of good pages is surely below this is blocked.
LEAST_GOOD = 0.5
#: Bounds of the prior's worth in labelled pages, and its value where it cannot be told.
STRENGTHS = (2, 1000, 20)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty where there is no ``://`` or no url."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    empty = F.lit("")
    return (F.coalesce(F.translate(host, _UPPER, _LOWER), empty), F.coalesce(path, empty))


def levels(
    host: Column, suffixes: Sequence[str] = PUBLIC_SUFFIXES
) -> tuple[Column, Column]:
    """Registered domain and suffix of a host.

    The suffix is the longest of ``suffixes`` that the host ends with at a dot or is, else its last
    label; the registered domain has one label more, if the host has one.
    """
    def last(labels: int) -> Column:
        return F.regexp_extract(host, rf"(?:[^.]*\.){{0,{labels - 1}}}[^.]*$", 0)

    suffix, domain = last(1), last(2)
    by_size: dict[int, list[str]] = {}
    for known in suffixes:
        by_size.setdefault(known.count(".") + 1, []).append(known)
    for size, known in sorted(by_size.items()):  # longer ones are looked at first
        fits = last(size).isin(known)
        suffix = F.when(fits, last(size)).otherwise(suffix)
        domain = F.when(fits, last(size + 1)).otherwise(domain)
    return domain, suffix


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """The longest rule that fits, as a struct (rule, verdict); null if none does."""
    found = None
    for rule, verdict in sorted(rules, key=lambda r: -len(r[0])):
        name, slash, start = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + start)
        value = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, value) if found is None else found.when(fits, value)
    return found if found is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def outcomes(labels: DataFrame) -> DataFrame:
    """One outcome per labelled page: (page_id, good), 0 if any of its labels says bad."""
    return (
        labels.select(F.col("doc_id").alias("page_id"), F.col("quality").alias("_q"))
        .filter(F.col("page_id").isNotNull() & F.col("_q").isNotNull())
        .groupBy("page_id")
        .agg(F.min(F.when(F.col("_q") > 0, 1).otherwise(0)).alias("good"))
    )


def prior_strength(level: DataFrame, bounds: tuple[int, int, int] = STRENGTHS) -> DataFrame:
    """One row ``strength``: how many labelled pages the parent's mean is worth.

    ``level`` has (n, good) per site. The moment estimate of the between-site correlation r gives
    (1 - r) / r, as a whole number within bounds. Sums are of whole numbers, so the result does
    not depend on the order of rows.
    """
    low, high, default = bounds
    total = level.agg(
        F.count(F.lit(1)).alias("sites"),
        F.sum("n").alias("n"),
        F.sum("good").alias("good"),
        F.sum(F.expr("good * good * 1000 div n")).alias("squares"),
        F.sum(F.col("n") * F.col("n")).alias("weights"),
    )
    mean = F.col("good") / F.col("n")
    between = F.col("squares") / 1000.0 - F.col("good") * mean
    within = mean * (1 - mean)
    freedom = F.col("sites") - 1
    ratio = F.try_divide(
        between - freedom * within,
        within * (F.col("n") - F.col("weights") / F.col("n") - freedom),
    )
    worth = F.round(F.try_divide(1 - ratio, ratio))
    return total.select(
        F.when(ratio.isNull() | worth.isNull(), F.lit(default))
        .when(ratio <= 0, F.lit(high))
        .otherwise(F.greatest(F.lit(low), F.least(F.lit(high), worth)))
        .cast("double")
        .alias("strength")
    )


def _shrunk(good: str, n: str, parent: Column, strength: Column) -> Column:
    return (F.col(good) + strength * parent) / (F.col(n) + strength)


def host_reputation(
    pages: DataFrame,
    labels: DataFrame,
    bound_sd: float = BOUND_SD,
    suffixes: Sequence[str] = PUBLIC_SUFFIXES,
) -> DataFrame:
    """Posterior of every host: (host, labelled, good, mean, upper).

    Hosts without labels have their parents' mean. All labelled pages count; they are summed
    before any join, so the tables joined here have one row per site.
    """
    host, _ = url_parts(F.col("url"))
    seen = (
        pages.select(F.col("page_id"), host.alias("host"))
        .join(outcomes(labels), "page_id", "left")
        .groupBy("host")
        .agg(F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"))
    )
    domain, suffix = levels(F.col("host"), suffixes)
    hosts = held(seen.withColumns({"domain": domain, "suffix": suffix})).df
    domains = hosts.groupBy("suffix", "domain").agg(
        F.sum("n").alias("dn"), F.sum("good").alias("dgood")
    )
    by_suffix = hosts.groupBy("suffix").agg(F.sum("n").alias("sn"), F.sum("good").alias("sgood"))
    whole = hosts.agg(
        ((F.coalesce(F.sum("good"), F.lit(0)) + 1) / (F.coalesce(F.sum("n"), F.lit(0)) + 2))
        .alias("mean")
    )
    worth = prior_strength(
        hosts.filter("n > 0").groupBy("domain").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    )
    fixed = {"whole": whole.first()["mean"], "worth": worth.first()["strength"]}  # two numbers
    whole_mean, strength = F.lit(fixed["whole"]), F.lit(fixed["worth"])
    suffix_mean = _shrunk("sgood", "sn", whole_mean, strength)
    domain_mean = _shrunk("dgood", "dn", F.col("smean"), strength)
    host_mean = _shrunk("good", "n", F.col("dmean"), strength)
    variance = F.col("mean") * (1 - F.col("mean")) / (F.col("n") + strength + 1)
    return (
        hosts.join(domains.join(by_suffix.withColumn("smean", suffix_mean), "suffix")
                   .select("domain", domain_mean.alias("dmean")), "domain")
        .select("host", "n", "good", host_mean.alias("mean"))
        .select(
            "host", F.col("n").alias("labelled"), "good", "mean",
            (F.col("mean") + F.lit(bound_sd) * F.sqrt(variance)).alias("upper"),
        )
    )


def judge_urls(
    pages: DataFrame,
    labels: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    least_good: float = LEAST_GOOD,
    bound_sd: float = BOUND_SD,
    suffixes: Sequence[str] = PUBLIC_SUFFIXES,
) -> DataFrame:
    """A verdict on every page's url, one row per input row.

    (page_id, host, path, rule, verdict, labelled, good): the longest rule that fits decides, else
    the host's posterior. A missing url or one without ``://`` has an empty host and path and the
    posterior of the empty host. Pages with repeated ids are judged each by its own url. Only
    ``page_id`` and ``url`` are read. Hosts are broadcast only if their measured size allows it.
    """
    host, path = url_parts(F.col("url"))
    hosts = held(host_reputation(pages, labels, bound_sd, suffixes))
    cut = (
        pages.select("page_id", host.alias("host"), path.alias("path"))
        .withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
    )
    own = F.when(F.col("upper") < F.lit(least_good), F.lit("block")).otherwise(F.lit("allow"))
    return cut.join(hosts.prepared(), "host", "left").select(
        F.col("page_id").cast("long"), "host", "path",
        F.col("_rule.rule").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), own).alias("verdict"),
        F.coalesce("labelled", F.lit(0)).cast("long").alias("labelled"),
        F.coalesce("good", F.lit(0)).cast("long").alias("good"),
    )

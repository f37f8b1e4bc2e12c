"""URL verdicts: rules first, then the reputation of the host.

Labelled pages give each host a count of bad outcomes. A host's rate is shrunk
towards that of its registered domain, the domain's towards its public suffix, the
suffix's towards all pages: each level's posterior mean is the mean of the beta prior
below it. How strong the priors are is estimated from the spread of the host
rates (moments of the beta-binomial). A url is blocked when even the lower bound of its
host's posterior lies above the accepted rate. A host without labels has the posterior of
no outcomes: the rate of its domain, or of its suffix, or of all pages, whichever is the
first that has labels; so a new subdomain of a bad domain is blocked.

Everything is DataFrame functions. Counts are combined before the shuffle; the
table of hosts is written, so that the join back reads both sides from a shuffle
and a host with a third of all pages is split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.operators.skew import lookup
from ridgeline.runtime import materialize

# Given rules as (host and path prefix, verdict).
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
# Suffixes of two names under which domains are registered; all others have one.
TWO_PART_SUFFIXES = ("ac.uk", "co.in", "co.jp", "co.nz", "co.uk", "com.au", "com.br", "com.cn", "org.uk")
# The accepted rate of bad pages, and the normal quantile of the one-sided bound.
MAX_BAD = 0.3
BOUND_Z = 1.645
# Limits of the estimated prior strength, in pages.
MIN_STRENGTH, MAX_STRENGTH = 4.0, 1000.0


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def suffix_of(host: Column, two_part: Sequence[str] = TWO_PART_SUFFIXES) -> Column:
    """The public suffix: the last name, or the last two where those are listed."""
    bare = F.regexp_replace(host, r":\d*$", "")
    two = F.substring_index(bare, ".", -2)
    return F.when(two.isin(*two_part), two).otherwise(F.substring_index(bare, ".", -1))


def domain_of(host: Column, two_part: Sequence[str] = TWO_PART_SUFFIXES) -> Column:
    """The registered domain: the public suffix and the name before it."""
    bare = F.regexp_replace(host, r":\d*$", "")
    two = F.substring_index(bare, ".", -2)
    return F.when(two.isin(*two_part), F.substring_index(bare, ".", -3)).otherwise(two)


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; both null where none does.

    A rule fits its host and all subdomains if the path starts with the rule's. Of
    equally long ones the alphabetically first wins. Rules become one expression
    each, so a list is meant to be written by hand.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), [-ord(c) for c in r[0]])):
        at = text.find("/")
        name, start = (text, "") if at < 0 else (text[:at], text[at:])
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def _posterior(mean: Column, strength: Column, bad: Column, n: Column) -> Column:
    return (strength * mean + bad) / (strength + n)


def _named(df: DataFrame) -> DataFrame:
    return df.withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))})


def reputations(outcomes: DataFrame, asked: DataFrame | None = None) -> DataFrame:
    """``(host, n, bad, rate, low)`` for labelled pages ``(host, bad 0/1)``, and for the hosts of ``asked`` if given.

    ``rate`` is the posterior mean, ``low`` its lower bound. Without a spread between
    hosts the prior is as strong as it may be; with one host or none likewise. It is
    never stronger than the labelled pages and the two of the uniform prior over them.
    """
    # One row per host from here on: combined before the shuffle, read again by each level.
    hosts = outcomes.where(F.col("bad").isNotNull()).groupBy("host").agg(
        F.count("*").alias("n"), F.sum(F.col("bad").cast("long")).alias("bad")
    )
    hosts = materialize(_named(hosts), "host-counts")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("domain_n"), F.sum("bad").alias("domain_bad"))
    suffixes = hosts.groupBy("suffix").agg(F.sum("n").alias("suffix_n"), F.sum("bad").alias("suffix_bad"))
    # Sums of whole numbers only, so that the order of rows cannot change a digit but in the last sum.
    whole = hosts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("double").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("double").alias("bad"),
        F.coalesce(F.sum(F.col("n") * F.col("n")), F.lit(0)).cast("double").alias("squares"), F.count("*").cast("double").alias("hosts"),
        F.coalesce(F.sum(F.round(F.col("bad") * F.col("bad") / F.col("n"), 9).cast("decimal(38,9)")), F.lit(0)).cast("double").alias("spread"),
    )
    mean = (F.col("bad") + 1) / (F.col("n") + 2)
    around = F.col("spread") - 2 * mean * F.col("bad") + mean * mean * F.col("n")
    within = mean * (1 - mean)
    room = within * (F.col("n") - F.col("squares") / F.greatest(F.col("n"), F.lit(1.0)) - (F.col("hosts") - 1))
    excess = around - within * (F.col("hosts") - 1)
    strength = F.when((excess > 0) & (room > 0), room / excess - 1).otherwise(F.lit(MAX_STRENGTH))
    prior = whole.select(mean.alias("mean"), F.least(F.greatest(strength, F.lit(MIN_STRENGTH)), F.lit(MAX_STRENGTH), F.col("n") + 2).alias("strength"))
    prior = prior.first()  # one row
    s, m = F.lit(prior.strength), F.lit(prior.mean)
    by_suffix = materialize(
        suffixes.select("suffix", _posterior(m, s, F.col("suffix_bad"), F.col("suffix_n")).alias("suffix_rate")), "suffix-rates"
    )
    by_domain = materialize(
        lookup(domains, by_suffix, "suffix", ["domain"]).select(
            "domain", "suffix", _posterior(F.col("suffix_rate"), s, F.col("domain_bad"), F.col("domain_n")).alias("domain_rate")
        ), "domain-rates",
    )
    # Domain and suffix as one key: a domain that is itself a suffix elsewhere stays apart.
    both = F.concat("domain", F.lit("/"), "suffix")
    if asked is not None:
        new = _named(asked.select("host").distinct().join(hosts.select("host"), "host", "left_anti"))
        zero = F.lit(0).cast("long")
        hosts = hosts.unionByName(new.select("host", zero.alias("n"), zero.alias("bad"), "domain", "suffix"))
    placed = materialize(hosts.withColumn("both", both), "hosts")
    placed = lookup(placed, by_suffix, "suffix", ["host"], "left")
    placed = lookup(placed, by_domain.select(both.alias("both"), "domain_rate"), "both", ["host"], "left")
    prior_rate = F.coalesce("domain_rate", "suffix_rate", m)
    rate = _posterior(prior_rate, s, F.col("bad"), F.col("n"))
    low = F.col("rate") - BOUND_Z * F.sqrt(F.col("rate") * (1 - F.col("rate")) / (s + F.col("n") + 1))
    return placed.select("host", "n", "bad", rate.alias("rate")).withColumn("low", F.greatest(low, F.lit(0.0)))


def judge(
    pages: DataFrame, outcomes: DataFrame, url_col: str = "url", carry: list[str] | None = None,
    rules: Sequence[tuple[str, str]] = RULES, max_bad: float = MAX_BAD,
) -> DataFrame:
    """Per row: carried columns in a struct ``row``, ``host``, ``path``, ``rule``, ``verdict``,
    ``n_labelled`` and ``n_bad`` of the host, and ``rate`` and ``low`` of its posterior.

    ``outcomes`` are labelled pages ``(host, bad)``. A null url, or one without ``://``, has an
    empty host and path; an empty host has no reputation and is allowed. Repeated rows get equal verdicts; an empty table gives none.
    """
    url = F.col(f"`{url_col}`").cast("string")
    given = pages.select(
        F.struct(*[F.col(f"`{c}`") for c in carry or ["page_id"]]).alias("row"), host_of(url).alias("host"), path_of(url).alias("path")
    )
    asked = given.where("host <> ''").select("host").distinct()
    known = materialize(reputations(outcomes.where("host <> ''"), asked).withColumnRenamed("host", "known_host"), "host-reputation")
    rule, says = rule_for(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("low") > max_bad, F.lit("block")).otherwise(F.lit("allow"))
    return given.join(known, F.col("host") == F.col("known_host"), "left").select(
        "row", "host", "path", rule.alias("rule"), F.coalesce(says, own).alias("verdict"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_labelled"), F.coalesce("bad", F.lit(0)).cast("long").alias("n_bad"), "rate", "low",
    )

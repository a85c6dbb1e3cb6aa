"""URL filtering by rules and by the reputation of hosts, with DataFrame functions only.

The reputation of a host is the share of its labelled pages that turned out good. Hosts with few
labelled pages borrow from their registered domain, domains from their suffix and suffixes from
all pages: each level's beta prior has the mean of the level above and a strength that the moments
of the beta-binomial distribution give. A host is blocked when even the upper bound of its
posterior is below the wanted share.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctrisk.llm.common import materialise, salted_join

Z = 1.645
MIN_GOOD = 0.8
# Suffixes of two labels under which names are registered; fixed values, a parameter.
SUFFIXES = (
    "ac.uk", "co.uk", "gov.uk", "ltd.uk", "me.uk", "net.uk", "nhs.uk", "org.uk", "plc.uk", "sch.uk",
    "com.au", "edu.au", "gov.au", "id.au", "net.au", "org.au",
    "ac.jp", "co.jp", "go.jp", "ne.jp", "or.jp",
    "ac.nz", "co.nz", "govt.nz", "net.nz", "org.nz",
    "com.br", "gov.br", "net.br", "org.br", "com.cn", "edu.cn", "gov.cn", "net.cn", "org.cn",
    "ac.in", "co.in", "gov.in", "net.in", "org.in", "ac.kr", "co.kr", "go.kr", "or.kr",
    "ac.za", "co.za", "org.za", "com.ar", "com.mx", "com.tr", "com.tw", "com.hk", "com.sg",
    "com.ua", "com.pl", "co.il", "org.il", "co.id", "co.th",
)
# Limits of a prior's strength, in pages.
WEAKEST, STRONGEST = 1.0, 10_000.0


class Rule(NamedTuple):
    action: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_and_path(pages: DataFrame, url: str = "url") -> DataFrame:
    """Adds host and path; both are empty for a null url and for one without `://`."""
    rest = F.expr(f"CASE WHEN instr(`{url}`, '://') > 0 "
                  f"THEN substr(`{url}`, instr(`{url}`, '://') + 3) ELSE '' END")
    host = F.regexp_extract(rest, "^([^/?#]*)", 1)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return pages.withColumns({"host": F.coalesce(lower, F.lit("")),
                              "path": F.coalesce(path, F.lit(""))})


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and action of the longest rule that fits, null without one.

    A rule fits its host and all subdomains when the path starts with the rule's. The rules are
    part of the expression; there should be hundreds of them at most.
    """
    text = action = None
    for rule in sorted(rules, key=lambda r: (-len(r.text), r)):
        fits = (((host == rule.host) | host.endswith("." + rule.host))
                & path.startswith(rule.path))
        text = (F if text is None else text).when(fits, F.lit(rule.text))
        action = (F if action is None else action).when(fits, F.lit(rule.action))
    if text is None:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return text, action


def _levels(host: Column, suffixes: Sequence[str] = SUFFIXES) -> tuple[Column, Column]:
    """Registered domain and suffix of a host, without a port.

    The suffix is the longest of `suffixes` that the host ends in, else its last label; the domain
    has one label more. An address in numbers (IPv4, or IPv6 in brackets) is a domain of its own
    under the empty suffix. `suffixes` have two labels each; there should be hundreds at most.
    """
    name = F.regexp_replace(host, ":[0-9]*$", "")
    address = name.rlike(r"^([0-9]+\.){3}[0-9]+$") | name.startswith("[")
    two = F.substring_index(name, ".", -2)
    listed = two.isin(list(suffixes))
    domain = F.when(address, name).when(listed, F.substring_index(name, ".", -3)).otherwise(two)
    suffix = F.when(address, F.lit("")).when(listed, two).otherwise(
        F.substring_index(name, ".", -1))
    return domain, suffix


def _moments(children: DataFrame, name: str) -> Column:
    """Strength of the prior over the given groups (columns n and k), as a scalar subquery.

    Groups that differ no more than by chance share the strongest prior; one group alone says
    nothing about differences and gets the weakest.
    """
    n, k = F.col("n").cast("double"), F.col("k").cast("double")
    sums = children.where("n > 0").agg(
        F.count("*").alias("groups"), F.sum(n).alias("n"), F.sum(k).alias("k"),
        F.sum(n * n).alias("nn"), F.sum(k * k / n).alias("kkn"))
    p = F.col("k") / F.col("n")
    inner = p * (1 - p)
    # sum of n_i * (p_i - p)^2, less what chance alone gives, over the effective group size
    spread = F.col("kkn") - F.col("n") * p * p - (F.col("groups") - 1) * inner
    between = spread / F.nullif(F.col("n") - F.col("nn") / F.col("n"), F.lit(0.0))
    strength = (F.when(between.isNull(), F.lit(WEAKEST))
                .when(between > 0, inner / between - 1).otherwise(F.lit(STRONGEST)))
    strength = F.greatest(F.lit(WEAKEST), F.least(F.lit(STRONGEST), strength))
    return sums.select(F.coalesce(strength, F.lit(WEAKEST)).alias(name)).scalar()


def reputation(outcomes: DataFrame, z: float = Z,
               suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """Posterior of the good share of each host: host, n, k, good, good_upper.

    outcomes: host, n (labelled pages) and k (good ones), one row per host, zeros allowed. Only
    sums per domain and suffix are shuffled; many hosts of one domain or suffix are spread over
    salted partitions. Without any labelled page the prior is even.
    """
    domain, suffix = _levels(F.col("host"), suffixes)
    hosts = outcomes.withColumns({"domain": domain, "suffix": suffix})
    sums = [F.sum("n").alias("n"), F.sum("k").alias("k")]
    domains = hosts.groupBy("domain", "suffix").agg(*sums)
    endings = domains.groupBy("suffix").agg(*sums)
    mean = endings.agg(F.coalesce(F.try_divide(F.sum("k"), F.sum("n")), F.lit(0.5))).scalar()
    of_suffix, of_domain, of_host = (
        _moments(x, "m") for x in (endings, domains, outcomes))

    def shrunk(prior: Column, strength: Column) -> Column:
        return (strength * prior + F.col("k")) / (strength + F.col("n"))

    endings = endings.select("suffix", shrunk(mean, of_suffix).alias("suffix_mean"))
    domains = salted_join(domains, endings, ["suffix"], "domain")
    domains = domains.select("domain", shrunk(F.col("suffix_mean"), of_domain).alias("domain_mean"))
    hosts = salted_join(hosts, domains, ["domain"], "host").withColumn("strength", of_host)
    alpha = F.col("strength") * F.col("domain_mean") + F.col("k")
    total = F.col("strength") + F.col("n")
    good = alpha / total
    upper = good + F.lit(z) * F.sqrt(good * (1 - good) / (total + 1))
    return hosts.select("host", "n", "k", good.alias("good"), upper.alias("good_upper"))


def outcomes_by_host(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled and good pages of every host: host, n, k.

    pages: host and item, the id under which a page is labelled (null: none); labels: item and
    good (0 or 1). Pages are counted per host and item before they meet the labels; of an item
    labelled more than once every label counts. Hosts that share an item meet its label in salted
    partitions, and pages without an item meet no labels at all.
    """
    counted = pages.groupBy("host", "item").agg(F.count("*").alias("pages"))
    known = labels.where("item is not null").groupBy("item").agg(
        F.count("good").alias("n"), F.sum("good").alias("k"))
    without = counted.where("item is null").select(
        "host", "pages", F.lit(None).cast("long").alias("n"), F.lit(None).cast("long").alias("k"))
    per_host = salted_join(counted.where("item is not null"), known, ["item"], "host").select(
        "host", "pages", "n", "k").unionByName(without)
    return per_host.groupBy("host").agg(
        F.coalesce(F.sum(F.col("pages") * F.col("n")), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.col("pages") * F.col("k")), F.lit(0)).alias("k"))


def judge(pages: DataFrame, labels: DataFrame, rules: Sequence[Rule],
          min_good: float = MIN_GOOD, z: float = Z,
          suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """Every page with host, path, rule, verdict and good_upper.

    pages: page_id, url and item (see outcomes_by_host); other columns are ignored. The verdict is
    the fitting rule's, else `block` where the posterior bound of the host is below `min_good`,
    else `allow`. A null or empty url belongs to the empty host, which is judged like any other.
    Repeated rows give repeated rows; an empty table gives no rows; without labels the rules alone
    block.
    """
    parsed = host_and_path(pages.select("page_id", "url", "item"))
    outcomes = materialise(outcomes_by_host(parsed.select("host", "item"), labels))
    bounds = reputation(outcomes, z, suffixes)
    text, action = rule_of(F.col("host"), F.col("path"), rules)
    verdict = F.coalesce(action, F.when(F.col("good_upper") < min_good, "block").otherwise("allow"))
    judged = salted_join(parsed, bounds.select("host", "good_upper"), ["host"], "page_id")
    return judged.select("page_id", "host", "path", text.alias("rule"), verdict.alias("verdict"),
                         "good_upper")

"""URL filtering by rules and empirical-Bayes host reputation.

DataFrame functions only. Labelled page outcomes are summed by host, by
registered domain and by suffix. At each level a beta-binomial prior is centred
on the posterior mean one level up (host from domain, domain from suffix,
suffix from all pages); its strength is fitted to the spread of that level's
rates by the method of moments. A host is blocked where a lower bound of its
posterior bad-page rate is above a threshold, so a few bad pages on a little
known host do not block it.

Registered domains come from public-suffix rules: names such as ``co.uk``, wildcards
(``*.ck``) and exceptions (``!www.ck``), given as a table of such lines (the list's own
comments and blank lines are left out) or, without one, the few of ``SUFFIXES``. A
domain is its suffix and the label before it; the rule of most labels counts, an
exception before all, and without a rule the last label is the suffix. Name rules are
matched as written, so lists and hosts have to use one form of non-ASCII names.

Edge cases: a user name and a port are no part of the domain (``a@x.org:80`` is of
``x.org``), though they stay in the host; an address (IPv4, or one in brackets) is
domain and suffix by itself; empty labels and a last dot do not count; a null URL, or
one without ``://``, has empty host and path and the reputation of the empty host; outcomes that are null do not count; hosts
without labels get their domain's, suffix's or the overall prior; without any
labels nothing is blocked by reputation. Page rows that repeat are judged one
by one; only the named input columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import store

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Public-suffix rules where no list is given.
SUFFIXES = ("ac.uk", "co.jp", "co.nz", "co.uk", "com.au", "com.br", "com.cn", "org.uk")
#: Labels of a host, from its end, that suffix rules are matched with (the longest public rule has five).
RULE_LABELS = 8
#: Rules are literals of one expression; a longer list belongs in a joined table.
MAX_RULES = 500


def url_host(url: str = "url") -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end; A-Z in lower case; empty without ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def url_path(url: str = "url") -> Column:
    """From behind the host to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def bare_name(host: Column) -> Column:
    """The host without user name, port and dots at its ends."""
    return F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r"^\.+|\.*(:[0-9]*)?$", "")


def is_address(name: Column) -> Column:
    return name.rlike(r"^([0-9]{1,3}\.){3}[0-9]{1,3}$|^\[.*\]?$")


def suffix_rules(lines: DataFrame) -> DataFrame:
    """``name, labels, kind`` of the rules in the first column of ``lines``, as a public-suffix list has them."""
    line = F.lower(F.regexp_extract(F.col(lines.columns[0]), r"^\s*([^\s/]\S*)", 1))
    rules = lines.select(line.alias("line")).where("line <> ''")
    kind = F.when(F.col("line").startswith("!"), "exception").when(F.col("line").startswith("*."), "wildcard").otherwise("name")
    return rules.select(F.regexp_replace("line", r"^(!|\*\.)", "").alias("rule"), kind.alias("kind")).distinct()


def with_domains(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """``hosts`` (a row for each ``host``) with ``domain`` and ``suffix``. rules: of ``suffix_rules``.

    Each host is looked up by its endings, at most RULE_LABELS of them, in one join with the rules.
    """
    name = bare_name(F.col("host"))
    labels = F.filter(F.split(name, r"\."), lambda x: x != "")
    last = lambda labels, k: F.array_join(F.slice(labels, F.greatest(F.lit(1), F.size(labels) - k + 1), F.greatest(F.lit(0), F.least(k, F.size(labels)))), ".")
    split = hosts.withColumns({"_name": name, "_labels": labels})
    ends = split.where(~is_address(F.col("_name")) & (F.size("_labels") > 0))
    ends = ends.select("host", F.size("_labels").alias("_n"), F.explode(F.sequence(F.lit(1), F.least(F.lit(RULE_LABELS), F.size("_labels")))).alias("_k"), "_labels")
    ends = ends.select("host", "_n", "_k", last(F.col("_labels"), F.col("_k")).alias("rule"))
    # labels of the suffix by each rule that fits: a wildcard takes one more (there has to be one), an exception one less
    took = F.when(F.col("kind") == "name", F.col("_k")).when((F.col("kind") == "wildcard") & (F.col("_n") > F.col("_k")), F.col("_k") + 1).when(F.col("kind") == "exception", F.col("_k") - 1)
    found = ends.join(rules, "rule").select("host", F.struct((F.col("kind") == "exception").alias("first"), took.alias("labels")).alias("x")).where("x.labels IS NOT NULL")
    best = found.groupBy(F.col("host").alias("_of")).agg(F.max("x").alias("_x"))
    rows = split.join(best, F.col("host") == F.col("_of"), "left")
    count = F.coalesce(F.col("_x.labels"), F.lit(1))
    alone = is_address(F.col("_name")) | (F.size("_labels") == 0)
    return rows.select(
        *hosts.columns,
        F.when(alone, F.col("_name")).otherwise(last(F.col("_labels"), count + 1)).alias("domain"),
        F.when(alone, F.col("_name")).otherwise(last(F.col("_labels"), count)).alias("suffix"),
    )


def longest_rule(rules: list[tuple[str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, null if none fits. A rule is ``(verdict, "host/path")``."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} are compiled into one expression")
    name = verdict = None
    for kind, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        on, slash, rest = rule.partition("/")
        fits = ((host == on) | host.endswith("." + on)) & path.startswith(slash + rest)
        name = F.when(fits, rule) if name is None else name.when(fits, rule)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    empty = F.lit(None).cast("string")
    return (empty, empty) if name is None else (name, verdict)


def _shrink(children: DataFrame, parent_mean: str) -> DataFrame:
    """Adds ``mean`` and ``strength``: children ``bad`` of ``seen`` under a beta prior around ``parent_mean``.

    Method of moments: with r = bad/seen, the weighted squared deviation from the
    prior means is spread m(1-m) * (1 + (n-1) * rho) / n in expectation; rho, the
    intra-class correlation, gives the strength 1/rho - 1. It is kept in
    [1, 10000], and is 10000 where nothing says that children differ.
    """
    m, n, r = F.col(parent_mean), F.col("seen"), F.try_divide(F.col("bad"), F.col("seen"))
    sums = children.where(n > 0).agg(
        F.sum(n * n * (r - m) * (r - m)).alias("a"), F.sum(n * m * (1 - m)).alias("b"), F.sum(n * (n - 1) * m * (1 - m)).alias("c")
    )
    rho = F.try_divide(F.col("a") - F.col("b"), F.col("c"))
    strength = F.when(rho.isNull() | (rho <= 0.0001), 10000.0).otherwise(F.greatest(F.lit(1.0), F.least(F.lit(10000.0), 1.0 / rho - 1.0)))
    children = children.withColumn("strength", F.lit(sums.select(strength).first()[0]))
    return children.withColumn("mean", (F.col("bad") + F.col("strength") * m) / (n + F.col("strength")))


def host_reputation(hosts: DataFrame, z: float = 1.645, suffixes: DataFrame | None = None) -> DataFrame:
    """hosts: ``host, bad, seen`` (sums of labelled pages, a row for each host); suffixes: lines of a public-suffix list.

    Returns ``host, bad, seen, mean, low``: the posterior mean of the host's
    bad-page rate and ``z`` posterior standard deviations below it.
    """
    spark = hosts.sparkSession
    rules = suffix_rules(suffixes if suffixes is not None else spark.range(1).select(F.explode(F.array(*[F.lit(x) for x in SUFFIXES])).alias("line")))
    hosts = store.table(with_domains(store.table(hosts, "hosts"), rules), "hosts")
    sums = lambda df, *by: df.groupBy(*by).agg(F.sum("bad").alias("bad"), F.sum("seen").alias("seen"))
    domains = store.table(sums(hosts, "domain", "suffix"), "domains")
    suffixes = sums(domains, "suffix")
    overall = suffixes.agg((F.coalesce(F.sum("bad"), F.lit(0)) + 1.0) / (F.coalesce(F.sum("seen"), F.lit(0)) + 2.0)).first()[0]
    suffixes = _shrink(suffixes.withColumn("above", F.lit(overall)), "above").select("suffix", F.col("mean").alias("above"))
    domains = _shrink(domains.join(suffixes, "suffix"), "above").select("domain", F.col("mean").alias("above"))
    hosts = _shrink(hosts.join(domains, "domain"), "above")
    a, b = F.col("bad") + F.col("strength") * F.col("above"), F.col("seen") - F.col("bad") + F.col("strength") * (1.0 - F.col("above"))
    spread = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1.0)))
    return hosts.select("host", "bad", "seen", "mean", (F.col("mean") - F.lit(z) * spread).alias("low"))


def filter_urls(pages: DataFrame, outcomes: DataFrame, rules: list[tuple[str, str]], z: float = 1.645, limit: float = 0.5, suffixes: DataFrame | None = None) -> DataFrame:
    """A verdict on every page: the longest fitting rule's, else the host's.

    pages: ``page_id, url``; outcomes: ``page_id, bad`` (0 or 1; several labels
    of a page all count). A host without a fitting rule is blocked if the lower
    posterior bound of its bad-page rate is above ``limit``. Returns
    ``page_id, host, path, rule, verdict, bad_rate, bad_rate_low``.
    """
    pages = pages.select("page_id", url_host().alias("host"), url_path().alias("path"))
    labels = outcomes.where(F.col("page_id").isNotNull() & F.col("bad").isNotNull()).groupBy("page_id").agg(F.sum("bad").cast("double").alias("bad"), F.count("bad").cast("double").alias("seen"))
    labelled = pages.join(labels, "page_id", "left")
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0.0)).alias(c)
    known = host_reputation(labelled.groupBy("host").agg(zero("bad"), zero("seen")), z, suffixes)
    rule, verdict = longest_rule(rules, F.col("host"), F.col("path"))
    return pages.join(known.select("host", F.col("mean").alias("bad_rate"), F.col("low").alias("bad_rate_low")), "host").select(
        "page_id",
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("bad_rate_low") > F.lit(limit), "block").otherwise("allow")).alias("verdict"),
        "bad_rate",
        "bad_rate_low",
    )

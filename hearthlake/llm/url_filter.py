"""URL filters with an empirical-Bayes host reputation (operator 10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthlake.llm.common import ascii_lower, checkpointed, given

#: (verdict, host, path): a rule fits its host and all subdomains where the url's path starts with the rule's.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: A host is blocked where its share of bad pages is above MOST_BAD, CONFIDENCE standard deviations from the mean.
MOST_BAD = 0.5
CONFIDENCE = 1.645
#: Words that stand before a country's code in a public suffix, as in co.uk.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")
#: The suffix that addresses, which have none, are grouped under; no label begins so.
ADDRESS = "#address"
#: Strength of a prior, in pages, and its bounds. The first holds where one group can't show how groups differ.
USUAL_STRENGTH, LEAST_STRENGTH, MOST_STRENGTH = 10.0, 0.5, 10_000.0


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def name_of(host: Column) -> Column:
    """The host without user, port and closing dot: what its suffix and domain are read from."""
    return F.regexp_replace(host, r"^.*@|\.?(?::[0-9]*)?$", "")


def is_address(name: Column) -> Column:
    return name.rlike(r"^(?:[0-9]{1,3}(?:\.[0-9]{1,3}){3}|\[.*\])$")


def suffix_of(name: Column) -> Column:
    """The public suffix: the last label, or the last two as in co.uk. All addresses share one."""
    two = F.regexp_extract(name, rf"(?:^|\.)((?:{'|'.join(SECOND_LEVEL)})\.[a-z]{{2}})$", 1)
    return F.when(is_address(name), F.lit(ADDRESS)).when(two != "", two).otherwise(F.substring_index(name, ".", -1))


def listed_suffixes(hosts: DataFrame, suffixes: DataFrame) -> DataFrame:
    """_name and _listed, the longest suffix of the table (suffix) that each name of ``hosts`` (_name) ends in, where one does."""
    labels = F.split("_name", r"\.")
    tails = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    names = hosts.select("_name").distinct().where(~is_address(F.col("_name")))
    known = suffixes.select(F.col("suffix").alias("_tail")).distinct()
    return names.select("_name", F.explode(tails).alias("_tail")).join(known, "_tail").groupBy("_name").agg(F.max_by("_tail", F.length("_tail")).alias("_listed"))


def domain_of(name: Column, suffix: Column) -> Column:
    """The registered domain: the suffix and the label before it; an address is its own."""
    return F.when(is_address(name), name).otherwise(_labels_from(name, suffix))


def _labels_from(host: Column, suffix: Column) -> Column:
    labels = F.size(F.split(suffix, r"\.")) + 1
    return F.array_join(F.reverse(F.slice(F.reverse(F.split(host, r"\.", -1)), F.lit(1), labels)), ".")


def longest_rule(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...] = RULES) -> Column:
    """A struct of the longest fitting rule and its verdict, NULL if none fits; a few hundred rules at most.

    Of two rules of one length the one given first wins.
    """
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(reversed(rules), key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        found = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def strength(groups: DataFrame) -> float:
    """How many pages a prior is worth, from how much the groups (n, bad) differ beyond chance.

    The method of moments for a beta-binomial: with the weighted variance S of the
    groups' shares around the mean m, the correlation inside a group is
    (S - (k - 1) m (1 - m)) / (m (1 - m) (N - sum(n^2) / N - (k - 1))), and the
    strength is 1 / correlation - 1. Only the sums reach the driver.
    """
    row = groups.where("n > 0").agg(
        F.count(F.lit(1)).alias("k"),
        F.sum("n").alias("n"),
        F.sum("bad").alias("bad"),
        F.sum(F.col("bad") * F.col("bad") / F.col("n")).alias("squares"),
        F.sum(F.col("n").cast("double") * F.col("n")).alias("n2"),
    ).first()
    if not row.n or row.k < 2:
        return USUAL_STRENGTH
    mean = row.bad / row.n
    chance = mean * (1 - mean)
    free = row.n - row.n2 / row.n - (row.k - 1)
    if chance == 0 or free <= 0:
        return USUAL_STRENGTH
    inside = (row.squares - row.n * mean * mean - (row.k - 1) * chance) / (chance * free)
    if inside <= 0:
        return MOST_STRENGTH
    return min(MOST_STRENGTH, max(LEAST_STRENGTH, 1 / inside - 1))


def reputations(outcomes: DataFrame, suffixes: DataFrame | None = None) -> DataFrame:
    """host, n, bad, mean, lower: the posterior share of bad pages of every host and its lower bound.

    ``outcomes`` has host and bad (1, 0, NULL if not labelled), one row per page. Each
    level's posterior mean is the next one's prior mean: all pages, suffix, registered
    domain, host. A host without labelled pages gets its domain's. Pages are counted by
    host before anything is shuffled; levels above see one row per host and less.
    ``suffixes`` (suffix) is a list of public suffixes; hosts that none fits, and all
    without it, go by the last label or the last two as in co.uk. User and port don't
    count for domain and suffix; an address is its own domain, and all share a suffix.
    """
    hosts = outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("long").alias("bad"))
    hosts = hosts.withColumn("_name", name_of(F.col("host"))).withColumn("_suffix", suffix_of(F.col("_name")))
    if suffixes is not None:
        hosts = hosts.join(listed_suffixes(hosts, suffixes), "_name", "left").withColumn("_suffix", F.coalesce("_listed", "_suffix")).drop("_listed")
    hosts = checkpointed(hosts.withColumn("_domain", domain_of(F.col("_name"), F.col("_suffix"))).drop("_name"))
    domains = hosts.groupBy("_domain", "_suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("_suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    total = suffixes.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    root = (total.bad or 0) / total.n if total.n else 0.0

    def shrunk(k: float) -> Column:
        return (F.lit(k) * F.col("_prior") + F.col("bad")) / (F.lit(k) + F.col("n"))

    of_suffix = suffixes.withColumn("_prior", F.lit(root)).select("_suffix", shrunk(strength(suffixes)).alias("_prior"))
    of_domain = domains.join(of_suffix, "_suffix").select("_domain", "_suffix", shrunk(strength(domains)).alias("_prior"))
    k = strength(hosts)
    mean = shrunk(k)
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.lit(k + 1.0) + F.col("n")))
    return (
        hosts.join(of_domain, ["_domain", "_suffix"])
        .withColumn("mean", mean)
        .withColumn("lower", F.greatest(F.lit(0.0), F.col("mean") - F.lit(CONFIDENCE) * deviation))
        .select("host", "n", "bad", "mean", "lower")
    )


def judged(pages: DataFrame, outcomes: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, one row for each row of ``pages`` (page_id, url).

    ``outcomes`` (page_id, bad) labels some pages, once at most each; bad is 1 or 0. The
    longest fitting rule decides; without one the host's lower bound does. A NULL url or
    one without ``://`` has an empty host and path, which are judged like any others.
    Without any labels every host's bound is 0 and the method allows. Rows that repeat
    are judged each for itself. An empty table gives an empty result.
    """
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    labelled = rows.join(outcomes.select("page_id", "bad"), "page_id", "left")
    blocked = reputations(labelled).where(F.col("lower") > MOST_BAD).select("host", F.lit(True).alias("_blocked"))
    return (
        rows.join(blocked, "host", "left")
        .withColumn("_rule", longest_rule(F.col("host"), F.col("path"), rules))
        .select(
            "page_id",
            "host",
            "path",
            F.col("_rule.rule").alias("rule"),
            F.coalesce(F.col("_rule.verdict"), F.when(F.col("_blocked"), "block").otherwise("allow")).alias("verdict"),
        )
    )


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """page_id and bad, for pages whose document has a label.

    A page's document is the number that its path ends in. It is bad where it is toxic or
    of quality 0; where a document has several labels, if any says so.
    """
    number = F.regexp_extract(path_of(F.col("url")), r"/([0-9]{1,18})(?:\.html)?/?$", 1)
    bad = labels.groupBy("doc_id").agg(F.max(F.greatest(F.col("toxic"), 1 - F.col("quality"))).alias("bad"))
    shown = pages.select("page_id", F.when(number != "", number.cast("long")).alias("doc_id")).where("doc_id IS NOT NULL")
    return shown.join(bad, "doc_id").groupBy("page_id").agg(F.max("bad").alias("bad"))


def op10_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = given(spark, sf_dir, "pages")
    return judged(pages, page_outcomes(pages, given(spark, sf_dir, "labels")))

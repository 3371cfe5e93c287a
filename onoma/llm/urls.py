"""URL filtering: explicit rules first, then the reputation of hosts by empirical Bayes.

Labelled page outcomes are counted by host. The bad share of a suffix shrinks to that of all pages, a registered
domain's to its suffix's, a host's to its domain's; each level is a beta-binomial whose concentration is fitted by
moments to the level's own counts. A host is blocked if its posterior bad share is surely high: the lower bound, mean
less Z posterior standard deviations, exceeds `most`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from onoma.llm.common import checkpoint

MOST, Z = 0.5, 1.645
#: Public suffixes of two labels, under which a registered domain has three; a parameter of judge.
SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "or.jp", "ac.jp", "co.kr", "com.br", "com.cn", "com.tw", "com.hk", "com.mx", "com.tr", "co.in", "co.za")
#: A host or domain that no label covers keeps its parent's mean; concentrations stay within these bounds.
LEAST_M, MOST_M = 1.0, 1000.0
#: Longest rule list that is one conditional expression; more rules are joined by host.
INLINE = 200


def host_of(url: Column) -> Column:
    got = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(got, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def parse_rules(lines: list[str]) -> list[tuple[str, str, str]]:
    """'block com/en/' -> (verdict, host, path)."""
    out = []
    for line in lines:
        verdict, _, target = line.partition(" ")
        host, slash, path = target.partition("/")
        out.append((verdict, host, slash + path))
    return out


def ruled(pages: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """pages with host and path -> with rule and ruling of the longest rule that fits, else null.

    A rule fits its host and all subdomains if the path starts with the rule's.
    """
    if len(rules) <= INLINE:
        rule, ruling = F.lit(None).cast("string"), F.lit(None).cast("string")
        for verdict, host, path in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]), r[0] == "block", r)):
            fits = (F.concat(F.lit("."), "host").endswith("." + host)) & F.col("path").startswith(path)
            rule, ruling = F.when(fits, F.lit(host + path)).otherwise(rule), F.when(fits, F.lit(verdict)).otherwise(ruling)
        return pages.withColumns({"rule": rule, "ruling": ruling})
    listed = pages.sparkSession.createDataFrame(rules, "r_verdict string, r_host string, r_path string")
    parts = F.split("host", r"\.")
    names = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, k, F.size(parts)), "."))
    keyed = pages.select("host", "path").distinct().withColumn("r_host", F.explode(names))
    order = F.struct((F.length("r_host") + F.length("r_path")).alias("a"), F.length("r_host").alias("b"), (F.col("r_verdict") == "block").alias("c"))
    best = keyed.join(listed, "r_host").where(F.col("path").startswith(F.col("r_path"))).groupBy("host", "path").agg(F.max_by(F.struct(F.concat("r_host", "r_path").alias("rule"), F.col("r_verdict").alias("ruling")), order).alias("best"))
    return pages.join(best, ["host", "path"], "left").withColumns({"rule": F.col("best.rule"), "ruling": F.col("best.ruling")}).drop("best")


def _shrunk(counts: DataFrame, parent: str | None) -> DataFrame:
    """counts: (key, parent, n, bad, prior, m of the parent level) -> adds mean and strength."""
    mean = (F.col("bad") + F.col("m") * F.col("prior")) / (F.col("n") + F.col("m"))
    return counts.withColumn("mean", mean).withColumn("strength", F.col("n") + F.col("m"))


def concentration(groups: DataFrame) -> float:
    """m of beta-binomials around each group's prior, by moments: groups has n, bad, prior (of its parent)."""
    n, bad, p = F.col("n").cast("double"), F.col("bad").cast("double"), F.col("prior")
    var = p * (1 - p)
    # E (bad - n p)^2 = n var (1 + (n - 1) rho), rho = 1 / (m + 1)
    got = groups.where((n > 1) & (var > 0)).agg(F.sum((bad - n * p) * (bad - n * p) - n * var), F.sum(n * (n - 1) * var)).first()
    rho = min(max((got[0] or 0.0) / got[1], 1e-9), 0.999) if got[1] else 1.0 / (MOST_M + 1)
    return min(max(1 / rho - 1, LEAST_M), MOST_M)


def reputations(outcomes: DataFrame, two_label: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """outcomes: (host, bad 0/1/null) -> (host, mean, low): posterior mean and lower bound of every host's bad share.

    Null outcomes count as no label. Counts are summed before any join, so a host with many pages is one row; all that
    follows reads these counts, which are written once. The registered domain is the label before the suffix and the
    suffix: the last label, or the last two if they are one of two_label. A host of one label is all three.
    """
    hosts = checkpoint(outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")))
    parts = F.split("host", r"\.")
    last = lambda k: F.array_join(F.slice(parts, F.greatest(F.size(parts) - k + 1, F.lit(1)), F.lit(k)), ".")
    known = last(2).isin(*two_label) if two_label else F.lit(False)
    hosts = hosts.withColumn("domain", F.when(known, last(3)).otherwise(last(2)))
    hosts = hosts.withColumn("suffix", F.regexp_replace("domain", r"^[^.]*\.", ""))
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    n, bad = suffixes.agg(F.sum("n"), F.sum("bad")).first()
    base = (float(bad or 0) + 0.5) / (float(n or 0) + 1.0)
    suffixes = suffixes.withColumn("prior", F.lit(base))
    suffixes = _shrunk(suffixes.withColumn("m", F.lit(concentration(suffixes))), None).select("suffix", F.col("mean").alias("prior"))
    domains = domains.join(suffixes, "suffix")
    domains = _shrunk(domains.withColumn("m", F.lit(concentration(domains))), "suffix").select("domain", "suffix", F.col("mean").alias("prior"))
    hosts = hosts.join(domains, ["domain", "suffix"])
    hosts = _shrunk(hosts.withColumn("m", F.lit(concentration(hosts))), "domain")
    sd = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("strength") + 1))
    return hosts.select("host", "mean", (F.col("mean") - Z * sd).alias("low"))


def judge(pages: DataFrame, labels: DataFrame, rules: list[str], most: float = MOST, two_label: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """pages: (page_id, url), labels: (page_id, bad 0/1) -> (page_id, host, path, rule, verdict, mean).

    Null urls and urls without :// have empty host and path, which are judged like any host. Of several labels of a
    page the worst counts; repeated pages count each; pages without labels share their host's verdict; an empty table
    gives an empty result; urls may be of any length; other columns are ignored.
    """
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    worst = labels.select("page_id", "bad").where("page_id is not null and bad is not null").groupBy("page_id").agg(F.max("bad").alias("bad"))
    known = reputations(rows.select("page_id", "host").join(worst, "page_id", "left"), two_label)
    out = ruled(rows, parse_rules(rules)).join(known, "host", "left")
    verdict = F.coalesce("ruling", F.when(F.col("low") > most, F.lit("block")).otherwise(F.lit("allow")))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "mean")

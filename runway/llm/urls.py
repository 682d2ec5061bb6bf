"""URL filter by rules and by an empirical-Bayes host reputation.

Rules are looked up first (the longest that fits wins). Other urls are judged by
their site: the labelled outcomes of its pages, good or bad, are shrunk through
beta-binomial priors from the host to its registered domain to its suffix to all
pages. How strongly each level pulls is estimated from the data: the intra-class
correlation of its children (analysis of variance, unequal sizes) gives the
prior's strength. A host is blocked when its bad rate lies above ``limit`` with
posterior probability ``certainty`` or more.

Everything is a DataFrame expression. Outcomes are counted by site before any
join, so a hot host is pre-aggregated; the join that brings the verdicts back is
a plain equi-join whose right side is unique, which adaptive execution splits
where a host holds many pages. Only three strengths and the overall rate reach
the driver.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runway.llm.common import stage

# The rules of the registered query as (verdict, host, path).
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
# Suffixes of several labels under which domains are registered.
SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "com.br", "co.jp", "co.nz", "co.in")
LIMIT, CERTAINTY = 0.25, 0.95
STRENGTH = 10.0  # of a level whose children do not tell
WEAKEST, STRONGEST = 0.9, 1e-4  # correlations that bound a prior's strength
CELLS = 100  # of the quadrature, on each side of the limit
SPAN = 10.0  # its half width in standard deviations


def host_of(url: Column) -> Column:
    """From after the first :// up to /, ?, # or the end, A-Z in lower case; empty without ://."""
    host = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as ``host/path``, and its verdict; null without one."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, where, begins in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]))):
        fits = ((host == where) | host.endswith(f".{where}")) & path.startswith(begins)
        name, verdict = F.when(fits, F.lit(where + begins)).otherwise(name), F.when(fits, F.lit(says)).otherwise(verdict)
    return name, verdict


def levels(host: Column, suffixes=SUFFIXES) -> tuple[Column, Column, Column]:
    """Site (the host without user and port), registered domain and suffix. An IPv4
    address is its own domain and suffix."""
    site = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*$", "")
    known = "|".join(s.replace(".", r"\.") for s in suffixes)
    last = f"(?:{known}|[^.]+)" if known else "[^.]+"
    address = site.rlike(r"^[0-9.]+$")
    domain = F.regexp_extract(site, rf"(?:^|\.)((?:[^.]+\.)?{last})$", 1)
    suffix = F.regexp_extract(site, rf"(?:^|\.)({last})$", 1)
    return site, F.when(address, site).otherwise(domain), F.when(address, site).otherwise(suffix)


def _correlation(children: DataFrame, parent: str) -> float | None:
    """Intra-class correlation of outcomes among children of one parent, from the
    variance between and within them; None where it cannot be told."""
    of = children.where("n > 0").groupBy(parent).agg(
        F.count(F.lit(1)).alias("g"), F.sum("n").alias("n"), F.sum("k").alias("k"), F.sum(F.col("n").cast("double") * F.col("n")).alias("n2"),
        F.sum(F.col("k") * F.col("k") / F.col("n")).alias("q"))
    # sum of n (p - mean)^2 is the sum of k^2 / n less the parent's; of n p (1 - p) the sum of k less that of k^2 / n
    row = of.agg(F.sum("g").alias("g"), F.count(F.lit(1)).alias("p"), F.sum("n").alias("n"), F.sum(F.col("n2") / F.col("n")).alias("n2"),
                 F.sum(F.col("q") - F.col("k") * F.col("k") / F.col("n")).alias("between"), F.sum(F.col("k") - F.col("q")).alias("within")).first()
    if not row.g or row.g <= row.p or row.n <= row.g:
        return None
    between, within = max(0.0, row.between) / (row.g - row.p), max(0.0, row.within) / (row.n - row.g)
    n0 = (row.n - row.n2) / (row.g - row.p)
    total = between + (n0 - 1) * within
    return None if total <= 0 else (between - within) / total


def strength(correlation: float | None) -> float:
    """Prior observations that an intra-class correlation stands for."""
    if correlation is None:
        return STRENGTH
    return 1 / min(max(correlation, STRONGEST), WEAKEST) - 1


def tail(a: Column, b: Column, limit: float, cells: int = CELLS) -> Column:
    """Probability that a Beta(a, b) variable exceeds ``limit``.

    With x = sin^2(t) the density is smooth and its width about 1 / sqrt(a + b)
    everywhere; the midpoint rule runs on both sides of the limit.
    """
    mid = F.asin(F.sqrt(a / (a + b)))
    wide = F.lit(SPAN / 2) / F.sqrt(a + b)
    lo, hi = F.greatest(F.lit(0.0), mid - wide), F.least(F.lit(math.pi / 2), mid + wide)
    cut = F.least(F.greatest(F.lit(math.asin(math.sqrt(limit))), lo), hi)

    def density(t: Column) -> Column:
        return (2 * a - 1) * F.log(F.sin(t)) + (2 * b - 1) * F.log(F.cos(t))

    # about the highest point, so that no exponent overflows
    top = F.atan2(F.sqrt(F.greatest(2 * a - 1, F.lit(0.01))), F.sqrt(F.greatest(2 * b - 1, F.lit(0.01))))
    peak = density(top)

    def mass(start: Column, end: Column) -> Column:
        step = (end - start) / cells
        return F.when(step > 0, step * F.aggregate(
            F.sequence(F.lit(0), F.lit(cells - 1)), F.lit(0.0),
            lambda s, i: s + F.exp(density(start + (i + 0.5) * step) - peak))).otherwise(F.lit(0.0))

    above, below = mass(cut, hi), mass(lo, cut)
    return above / (above + below)


def outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """page_id, url and bad for labelled pages: a page holds the document that the
    number at its path's end names; it is bad if labelled low in quality or toxic."""
    marks = labels.where("doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL)").groupBy(
        F.col("doc_id").cast("long").alias("_doc")).agg(
        F.max((F.coalesce(F.col("quality"), F.lit(1)) == 0) | (F.coalesce(F.col("toxic"), F.lit(0)) == 1)).alias("bad"))
    number = F.regexp_extract(path_of(F.col("url")), r"/([0-9]+)(?:/|\.[A-Za-z]+)?$", 1).try_cast("long")
    return pages.select("page_id", "url", number.alias("_doc")).join(marks, "_doc").select("page_id", "url", "bad")


def reputation(pages: DataFrame, labelled: DataFrame, limit: float = LIMIT, suffixes=SUFFIXES) -> DataFrame:
    """One row a site: site, n labelled pages, k bad ones, rate (posterior mean of
    the bad rate), bound (posterior probability that it lies above ``limit``)."""
    site, domain, suffix = levels(host_of(F.col("url")), suffixes)
    seen = pages.select(site.alias("site"), domain.alias("domain"), suffix.alias("suffix"), F.lit(0).alias("n"), F.lit(0).alias("k")).unionAll(
        labelled.select(site, domain, suffix, F.lit(1), F.col("bad").cast("int")))
    sites = stage(seen.groupBy("site", "domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k")), "sites")
    domains = sites.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    ends = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k")).withColumn("everything", F.lit(0))
    m_site, m_domain, m_suffix = (strength(_correlation(t, p)) for t, p in ((sites, "domain"), (domains, "suffix"), (ends, "everything")))
    whole = ends.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("k"), F.lit(0)).alias("k")).first()
    base = (whole.k + limit / 2) / (whole.n + 1)  # one observation, half the limit, stands in for missing labels

    def shrunk(prior: Column, m: float) -> Column:
        return (m * prior + F.col("k")) / (m + F.col("n"))

    ends = ends.select("suffix", shrunk(F.lit(base), m_suffix).alias("prior"))
    domains = domains.join(ends, "suffix").select("domain", shrunk(F.col("prior"), m_domain).alias("prior"))
    both = sites.join(domains, "domain")
    a, b = m_site * F.col("prior") + F.col("k"), m_site * (1 - F.col("prior")) + F.col("n") - F.col("k")
    both = both.select("site", "n", "k", a.alias("a"), b.alias("b"))
    return both.select("site", "n", "k", (F.col("a") / (F.col("a") + F.col("b"))).alias("rate"), tail(F.col("a"), F.col("b"), limit).alias("bound"))


def judge(pages: DataFrame, labelled: DataFrame, rules=RULES, limit: float = LIMIT, certainty: float = CERTAINTY,
          suffixes=SUFFIXES) -> DataFrame:
    """The verdict on every page's url.

    ``labelled``: url and bad (boolean) of pages with a known outcome. Returns
    page_id, host, path, rule (the longest that fits, else null), verdict
    (allow or block), and for the site n_labelled, n_bad, rate and bound.

    A null url, or one without ://, has an empty host and path; such pages share
    one site. A null page_id is kept, repeated rows are judged as often as they
    occur, a null ``bad`` is no outcome. Without any labels every level has the
    same rate and nothing is blocked but by rules. No pages give no rows. Other
    columns are ignored.
    """
    pages = pages.select("page_id", F.col("url").cast("string").alias("url"))
    known = reputation(pages, labelled.select(F.col("url").cast("string").alias("url"), "bad").where("bad IS NOT NULL"), limit, suffixes)
    cut = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    cut = cut.withColumn("site", levels(F.col("host"), suffixes)[0])
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("bound") >= certainty, F.lit("block")).otherwise(F.lit("allow"))
    return cut.join(known, "site", "left").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_labelled"), F.coalesce("k", F.lit(0)).cast("long").alias("n_bad"), "rate", "bound")

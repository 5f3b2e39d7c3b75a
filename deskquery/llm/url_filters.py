"""URL filters: rules first, then the reputation of the host.

Rules judge a page by host and path; the longest that fits wins. The other pages
are judged by their host's reputation, by empirical Bayes. Outcomes come from
the pages whose host some rule speaks of, whatever their path: 1 where the rules
block the page, 0 where they allow it or, having looked at its host, let it
stand. So a host that only block rules reach collects outcomes of both kinds,
and is blocked only where most of its pages are; hosts that no rule reaches have
no outcomes. Outcomes are counted per host, registered domain (one label and the
public suffix) and public suffix, a beta prior is fitted to each level from the
spread of its rates (method of moments for the beta-binomial), and the estimate
is shrunk from the suffix to the domain to the host. A page is blocked when the
lower bound of its host's posterior, the mean less ``Z`` standard deviations,
passes ``THRESHOLD``. A host without outcomes is one more draw from the hosts of
its domain, else from the domains of its suffix: however many outcomes these
have, each counts once, so that one bad domain says little of its neighbours.

Cases: null urls and those without ``://`` have an empty host and path and are
allowed; a numeric address is its own domain and suffix, and a port belongs to
the host but to neither of these; rows that repeat are judged and counted as
often; urls of any length work; an empty table gives an empty result and fits
no prior; other columns pass through, whatever their names, and those with the
names of the results are replaced. Pages of a frequent host are not shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import boxed, cut, hot_keys, join_hot

#: (verdict, host, path prefix). Rules are configuration: a chain of tests, MAX_RULES at most.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
MAX_RULES = 1000
#: Public suffixes of two labels, from the public suffix list. All other suffixes are taken to have one.
SUFFIXES = (
    "ac.jp", "ac.nz", "ac.uk", "ac.za", "co.id", "co.il", "co.in", "co.jp", "co.ke", "co.kr", "co.nz", "co.th", "co.uk", "co.za", "com.ar", "com.au", "com.bd", "com.br", "com.cn", "com.co",
    "com.eg", "com.hk", "com.mx", "com.my", "com.ng", "com.pe", "com.ph", "com.pk", "com.sa", "com.sg", "com.tr", "com.tw", "com.ua", "com.vn", "edu.au", "edu.cn", "go.jp", "gob.mx", "gov.au", "gov.br",
    "gov.cn", "gov.in", "gov.uk", "ltd.uk", "me.uk", "ne.jp", "net.au", "net.br", "net.cn", "net.nz", "net.uk", "or.jp", "or.kr", "org.au", "org.br", "org.cn", "org.nz", "org.uk", "org.za", "sch.uk",
)
Z = 2.0
THRESHOLD = 0.5
#: Bounds of a prior's strength, in outcomes.
WEAKEST, STRONGEST = 0.5, 1000.0
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ADDED = ("host", "path", "rule", "verdict")


def split_url(url: Column) -> tuple[Column, Column]:
    """Host, lower-cased, and path."""
    after = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(after, r"\A([^/?#]*)", 1)
    path = F.regexp_extract(after, r"(?s)\A[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), path


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column, Column]:
    """The longest rule that fits, as text, and its verdict, null without one; and whether any rule speaks of the host."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; {MAX_RULES} at most")
    name = verdict = F.lit(None).cast("string")
    reached = F.lit(False)
    for v, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        inside = (host == h) | host.endswith(f".{h}")
        fits = inside & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    for h in sorted({h for _, h, _ in rules}):
        reached = reached | (host == h) | host.endswith(f".{h}")
    return name, verdict, reached


def _strength(counts: DataFrame) -> tuple[float, float]:
    """Mean and strength of the beta prior behind the rates r / n of the rows."""
    p = counts.agg(F.sum("n"), F.sum("r"), F.count(F.lit(1)), F.sum(1 / F.col("n"))).first()
    if not p[0]:
        return 0.5, WEAKEST
    mean, groups = p[1] / p[0], p[2]
    if groups < 2 or mean in (0, 1):
        return mean, STRONGEST
    spread = counts.agg(F.sum(F.col("n") * (F.col("r") / F.col("n") - mean) ** 2)).first()[0]
    variance = groups * spread / ((groups - 1) * p[0])
    extra = variance - mean * (1 - mean) * p[3] / groups
    strength = (mean * (1 - mean) - variance) / extra if extra > 0 else STRONGEST
    return mean, min(max(strength, WEAKEST), STRONGEST)


def reputation(outcomes: DataFrame) -> DataFrame:
    """Per host of the outcomes (host, n, r: how many of its n outcomes are bad): bound, the lower bound of its posterior blocked rate, and mean.

    Also one row per domain and per suffix, for hosts without outcomes: a bound from the rates of the hosts of the domain, or domains of the suffix, each counted once. key is host, domain or suffix with level 2, 1, 0."""
    host = outcomes.withColumns(levels(F.col("host")))
    both = [F.sum("n").alias("n"), F.sum("r").alias("r"), F.count(F.lit(1)).alias("c"), ((F.sum(F.col("r") / F.col("n")) + 0.5) / (F.count(F.lit(1)) + 1)).alias("u")]
    domain = host.groupBy("domain", "suffix").agg(*both)
    suffix = domain.groupBy("suffix").agg(*both)
    (mean, k0), (_, k1), (_, k2) = (_strength(x) for x in (suffix, domain, host))  # three rows of numbers

    def posterior(df: DataFrame, prior: Column, k: float, keep: list[str], level: int) -> DataFrame:
        a, total = F.col("r") + prior * k, F.col("n") + F.lit(k)
        m = a / total
        at, certain = (m, total) if level == 2 else (F.col("u"), F.col("c"))
        return df.select(*keep, F.lit(level).alias("level"), m.alias(f"m{level}"), (at - Z * F.sqrt(at * (1 - at) / (certain + 1))).alias("bound"))

    s = posterior(suffix, F.lit(mean), k0, ["suffix"], 0)
    d = posterior(domain.join(s.select("suffix", "m0"), "suffix"), F.col("m0"), k1, ["suffix", "domain"], 1)
    h = posterior(host.join(d.select("domain", "m1"), "domain"), F.col("m1"), k2, ["domain", "host"], 2)
    named = lambda df, key, level: df.select(F.col(key).alias("key"), "level", F.col(f"m{level}").alias("mean"), "bound")
    return named(h, "host", 2).union(named(d, "domain", 1)).union(named(s, "suffix", 0))


def levels(host: Column) -> dict[str, Column]:
    """The registered domain and the public suffix of a host."""
    name = F.regexp_replace(host, ":.*$", "")
    two, address = F.substring_index(name, ".", -2), name.rlike(r"\A[0-9.]+\z")
    known = two.isin(*SUFFIXES)
    return {
        "domain": F.when(address, name).when(known, F.substring_index(name, ".", -3)).otherwise(two),
        "suffix": F.when(address, name).when(known, two).otherwise(F.substring_index(name, ".", -1)),
    }


def judge(pages: DataFrame, rules=RULES, threshold: float = THRESHOLD) -> DataFrame:
    """pages with host, path, rule and verdict. The url is in the column url."""
    host, path = split_url(F.col("url"))
    rows = boxed(pages, host.alias("host"), path.alias("path"))
    rule, verdict, reached = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.select("row", "host", "path", rule.alias("rule"), verdict.alias("verdict"), reached.alias("reached"))
    # One row per distinct host, and one verdict: of the finest level that has outcomes the host's own, else its domain's, else its suffix's.
    count = lambda c: F.sum(c.cast("long"))
    hosts = cut(rows.groupBy("host").agg(F.count(F.lit(1)).alias("pages"), count(F.col("reached")).alias("n"), F.coalesce(count(F.col("verdict") == "block"), F.lit(0)).alias("r")))
    known = cut(reputation(hosts.filter("n > 0").select("host", "n", "r")))
    judged = hosts.select("host", "pages").withColumns(levels(F.col("host")))
    for level, key in ((2, "host"), (1, "domain"), (0, "suffix")):
        at = known.filter(F.col("level") == level).select(F.col("key").alias(key), F.col("bound").alias(f"b{level}"))
        judged = judged.join(at, key, "left")
    blocked = F.coalesce(F.coalesce("b2", "b1", "b0") > threshold, F.lit(False))
    verdicts = judged.select("host", F.when(blocked, "block").otherwise("allow").alias("method"))
    done = join_hot(rows, verdicts, ["host"], hot_keys(hosts, ["host"], "pages"))
    kept = [F.col("row").getField(c).alias(c) for c in pages.columns if c.lower() not in _ADDED]
    return done.select(*kept, "host", "path", "rule", F.coalesce("verdict", "method").alias("verdict"))

"""URL filter: written rules first, then a host's reputation by empirical Bayes.

Each page whose document is labelled is a trial. Bad outcomes are shrunk through beta
priors from the public suffix to the registered domain to the host; how far is
estimated from how much the groups of a level differ. A host is blocked when its bad
rate lies above a limit with the wanted certainty.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from chamberlens.llm.common import ascii_lower, free_names, without
from chamberlens.session import stored

#: (verdict, host and path prefix)
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
#: Suffixes of two labels under which domains are registered.
PAIRED_SUFFIXES = ("ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.au", "com.br", "com.cn", "com.mx", "com.tr", "gov.uk", "org.uk")
BAD_LIMIT, SIGMAS = 0.3, 1.2815515655446004


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; empty if there is none."""
    return ascii_lower(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise("")


def suffix_of(host: Column) -> Column:
    """The last label, or the last two where those are a known paired suffix."""
    pair = F.substring_index(host, ".", -2)
    return F.when(pair.isin(*PAIRED_SUFFIXES), pair).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    """The suffix and one label more."""
    labels = F.when(F.substring_index(host, ".", -2).isin(*PAIRED_SUFFIXES), -3).otherwise(-2)
    return F.when(labels == -3, F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits, else nulls. A rule fits its
    host and every subdomain, where the path starts with the rule's."""
    rule = verdict = F.lit(None).cast("string")
    for decision, written in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, rest = written.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + rest))
        rule = F.when(fits, F.lit(written)).otherwise(rule)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return rule, verdict


def host_reputation(
    trials: DataFrame,
    host_col: str = "host",
    bad_col: str = "bad",
    limit: float = BAD_LIMIT,
    sigmas: float = SIGMAS,
) -> DataFrame:
    """One row per host: ``host``, ``n_labelled``, ``n_bad``, ``mean``, ``bound``, ``blocked``.

    ``trials`` has a row per page; a null outcome is an unlabelled page, which gives the
    host its prior. Null hosts are left out. The concentration of each level's prior comes
    from the spread of the group rates about the overall rate (a weighted moment estimate
    of their intraclass correlation, held to 0.001 .. 0.5). ``bound`` is the posterior
    mean less ``sigmas`` posterior deviations; a host is blocked above ``limit``.
    Without any label the prior is flat about one half and no host is blocked.
    """
    outcome = F.col(bad_col).cast("double")
    hosts = stored(
        trials.where(F.col(host_col).isNotNull())
        .groupBy(F.col(host_col).alias("host"))
        .agg(F.count(outcome).alias("n"), F.coalesce(F.sum(outcome), F.lit(0.0)).alias("s"))
        .withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))})
    )
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    suffixes = hosts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    overall = hosts.agg(F.try_divide(F.sum("s") + 0.5, F.sum("n") + 1.0).alias("p"))
    p = F.coalesce(overall.scalar(), F.lit(0.5))

    def concentration(groups: DataFrame) -> Column:
        rate = F.try_divide(F.col("s"), F.col("n"))
        sums = groups.where("n > 0").select("n", (F.col("n") * (rate - p) * (rate - p)).alias("d"))
        return sums.agg(_concentration(F.sum("d"), F.sum("n"), F.sum(F.col("n") * F.col("n")), F.count("*"), p)).scalar()

    def shrunk(prior: Column, strength: Column) -> Column:
        return (F.col("s") + strength * prior) / (F.col("n") + strength)

    k_host, k_domain, k_suffix = concentration(hosts), concentration(domains), concentration(suffixes)
    by_suffix = suffixes.select("suffix", shrunk(p, k_suffix).alias("prior_s"))
    by_domain = (
        domains.join(by_suffix, "suffix").select("domain", "suffix", shrunk(F.col("prior_s"), k_domain).alias("prior_d"))
    )
    judged = hosts.join(by_domain, ["domain", "suffix"]).withColumn("k", k_host)
    bad, size = F.col("s") + F.col("k") * F.col("prior_d"), F.col("n") + F.col("k")
    mean = bad / size
    spread = F.sqrt(mean * (1 - mean) / (size + 1))
    return judged.select(
        "host",
        F.col("n").alias("n_labelled"),
        F.col("s").cast("bigint").alias("n_bad"),
        mean.alias("mean"),
        (mean - sigmas * spread).alias("bound"),
        (mean - sigmas * spread > limit).alias("blocked"),
    )


def _concentration(d: Column, n: Column, nn: Column, k: Column, p: Column) -> Column:
    """a + b of a level's beta prior, from the intraclass correlation of its groups."""
    noise = p * (1 - p)
    rho = F.try_divide(d - noise * (k - 1), noise * (n - F.try_divide(nn.cast("double"), n) - (k - 1)))
    held = F.least(F.greatest(F.coalesce(rho, F.lit(0.001)), F.lit(0.001)), F.lit(0.5))
    return 1 / held - 1


def filter_urls(
    pages: DataFrame,
    trials: DataFrame,
    url_col: str = "url",
    rules: Sequence[tuple[str, str]] = RULES,
    limit: float = BAD_LIMIT,
    sigmas: float = SIGMAS,
) -> DataFrame:
    """The pages with ``host``, ``path``, ``rule``, ``verdict``, ``bad_bound``.

    ``trials`` as for :func:`host_reputation`, hosts written as :func:`host_of` gives
    them. A rule decides before reputation; a host without trials is allowed. A null url
    or one without ``://`` has empty host and path and is judged as host ''. Input columns
    with the names of the results are replaced, repeated pages each keep a row.
    """
    added = ("host", "path", "rule", "verdict", "bad_bound")
    base = without(pages, *added)
    name, judged, blocked, decided = free_names(base, "_host", "_judged", "_blocked", "_decided")
    rule, verdict = matching_rule(F.col(name), F.col("path"), rules)
    reputation = host_reputation(trials, limit=limit, sigmas=sigmas).select(
        F.col("host").alias(judged), F.col("bound").alias("bad_bound"), F.col("blocked").alias(blocked)
    )
    parted = base.withColumns({name: host_of(F.col(url_col)), "path": path_of(F.col(url_col))})
    ruled = parted.withColumns({"rule": rule, decided: verdict})
    by_method = F.when(F.col(blocked), "block").otherwise("allow")
    joined = ruled.join(reputation, F.col(name) == F.col(judged), "left")
    return joined.select(
        *base.columns, F.col(name).alias("host"), "path", "rule", F.coalesce(F.col(decided), by_method).alias("verdict"), "bad_bound"
    )

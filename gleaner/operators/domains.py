"""Registrable domains and the URL outcome, as broadcast joins on suffixes of the host."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import urls as U
from .joins import Dictionary, lookup
from .spellings import other_spellings

URL_OK = "OK"


class SuffixRules:
    """Public-suffix rules keyed by the suffix text they are found under.

    `*.x` is stored under `x` with the flag `below`, `!x` under `x` with the flag `except`. Rules are
    stored under all spellings of their suffix, with letters and with xn-- labels.
    """

    def __init__(self, rules: DataFrame):
        rule = F.col("rule")
        keyed = rules.select(
            F.regexp_replace(F.lower(rule), r"\A(?:\*\.|!)", "").alias("suffix"),
            rule.startswith("*.").alias("is_below"),
            rule.startswith("!").alias("is_except"),
        )
        keyed = keyed.unionByName(other_spellings(keyed, "suffix"))
        table = keyed.groupBy("suffix").agg(
            F.max(~F.col("is_below") & ~F.col("is_except")).alias("plain"),
            F.max("is_below").alias("below"),
            F.max("is_except").alias("except"),
        )
        self.table = Dictionary(table.withColumn("depth", U.label_count(F.col("suffix"))))
        self.depths = sorted(r["depth"] for r in self.table.df.select("depth").distinct().collect())


def with_registrable_domain(
    df: DataFrame, rules: SuffixRules, host: str = "_bare", out: str = "domain"
) -> DataFrame:
    """Add the registrable domain of a host: the longest matching suffix plus one label.

    One left join per rule depth against the rules of that depth. The joins are on the row's own
    host, so nothing is grouped, and with the rules broadcast nothing is shuffled. Rules too large
    for that meet the distinct hosts only, and rows meet these once.
    """
    if not rules.table.small:
        names = df.select(host).where(F.col(host).isNotNull()).distinct()
        known = Dictionary(_resolved(names, rules, host, out))
        return lookup(df, known.df, [host], "left", small=known.small).select(*df.columns, out)
    return _resolved(df, rules, host, out)


def _resolved(df: DataFrame, rules: SuffixRules, host: str, out: str) -> DataFrame:
    labels = U.label_count(F.col(host))
    found = df
    for d in rules.depths:
        at_depth = rules.table.df.where(F.col("depth") == d).select(
            F.col("suffix").alias(f"_s{d}"),
            F.col("plain").alias(f"_plain{d}"),
            F.col("below").alias(f"_below{d}"),
            F.col("except").alias(f"_except{d}"),
        )
        suffix = F.when(labels >= d, F.substring_index(F.col(host), ".", -d))
        found = lookup(
            found.withColumn(f"_s{d}", suffix),
            at_depth,
            [f"_s{d}"],
            "left",
            small=rules.table.small,
        )
    suffix_labels = F.lit(None).cast("int")
    for k in sorted({d for d in rules.depths} | {d + 1 for d in rules.depths}):
        # Built from the shortest rule up, so the longest one is asked first.
        case = None
        if k in rules.depths:
            case = F.when(F.col(f"_plain{k}"), k).when(F.col(f"_except{k}"), k - 1)
        if k - 1 in rules.depths:
            hit = F.col(f"_below{k - 1}") & (labels >= k)
            case = case.when(hit, k) if case is not None else F.when(hit, k)
        suffix_labels = case.otherwise(suffix_labels)
    temporary = [f"_{kind}{d}" for d in rules.depths for kind in ("s", "plain", "below", "except")]
    return (
        found.withColumn("_suffix_labels", suffix_labels)
        .withColumn(
            out,
            F.when(
                labels > F.col("_suffix_labels"),
                F.call_function(
                    "substring_index", F.col(host), F.lit("."), -(F.col("_suffix_labels") + 1)
                ),
            ),
        )
        .drop("_suffix_labels", *temporary)
    )


def with_url_outcome(
    df: DataFrame, rules: SuffixRules, url: str = "url", check_prefix: bool = True
) -> DataFrame:
    """Add host, domain and url_outcome (OK or one of the ERR_URI_* names).

    With check_prefix, a host whose first occurrence of the domain leaves no label in front of
    it counts as malformed.
    """
    parts = (
        df.withColumn("_url", U.normal_url(F.col(url)))
        .withColumn("_hostport", U.host_and_port(F.col("_url")))
        .withColumn("host", U.host_of(F.col("_hostport")))
        .withColumn(
            "_parsed",
            U.scheme(F.col("_url")).isin(*U.KNOWN_SCHEMES) & U.port_is_valid(F.col("_hostport")),
        )
        .withColumn("_bare", U.bare_host(F.col("host")))
    )
    resolved = with_registrable_domain(parts, rules)
    outcome = (
        F.when(F.col(url).isNull(), "ERR_URI_PARSE")
        .when(~F.col("_parsed"), "ERR_URI_MALFORMED")
        .when(~U.host_is_legal(F.col("_bare")), "ERR_URI_ILLEGAL")
        .when(F.col("domain").isNull(), "ERR_URI_NO_SUFFIX")
    )
    if check_prefix:
        outcome = outcome.when(
            U.domain_offset_is_bad(F.col("host"), F.col("domain")), "ERR_URI_MALFORMED"
        )
    return (
        resolved.withColumn("url_outcome", outcome.otherwise(URL_OK))
        .withColumn("domain", F.when(F.col("url_outcome") == URL_OK, F.col("domain")))
        .drop("_url", "_hostport", "_parsed", "_bare")
    )


def with_canonical_host(df: DataFrame) -> DataFrame:
    """Add the host that categories are looked up under; null unless the URL is fine."""
    return df.withColumn(
        "canonical_host",
        F.when(
            F.col("url_outcome") == URL_OK, U.canonical_host(F.col("host"), F.col("domain"))
        ),
    )

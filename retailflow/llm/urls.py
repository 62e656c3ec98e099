"""URL filter: rules first, boosted trees for the rest.

Rules of (host, path) judge the urls they fit. The trees see only how a url
is written: lengths, depth, digit ratio, entropy of its characters,
parameters, and statistics of its suffix (the host's last label) over all
urls and over all labelled ones. They are trained on a bounded sample of
labelled urls; here those that a rule judges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailflow.llm.common import written
from retailflow.llm.trees import fit, probability

# The rules of the contract, as (verdict, host, path).
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
#: Labelled urls that the trees learn from at most, picked by hash.
MAX_LABELLED = 20_000
ROUNDS, DEPTH = 20, 4
#: Weight of the overall share in a suffix's share of blocked urls.
SMOOTHING = 20.0

FEATURES = (
    "url_length", "host_length", "path_length", "host_labels", "depth", "digit_ratio", "hyphens", "entropy",
    "parameters", "fragment", "suffix_length", "suffix_share", "suffix_blocked",
)

A_TO_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty for null or without ``://``."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), A_TO_Z, A_TO_Z.lower())


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fitting rule as {verdict, rule}, else null. A rule fits its
    host and all subdomains where the path starts with the rule's."""
    found = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, name, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(path, F.lit(start))
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(name + start).alias("rule"))).otherwise(found)
    return found


def entropy(x: Column) -> Column:
    """Bits a character."""
    each = F.split(x, "")
    n = F.greatest(F.size(each), F.lit(1)).cast("double")

    def part(c: Column) -> Column:
        share = F.size(F.filter(each, lambda e: e == c)) / n
        return -share * F.log2(share)

    return F.aggregate(F.transform(F.array_distinct(each), part), F.lit(0.0), lambda a, p: a + p)


def lexical(url: Column) -> dict[str, Column]:
    text, name, place = F.coalesce(url, F.lit("")), host(url), path(url)
    query = F.regexp_extract(text, r"(?s)\?([^#]*)", 1)
    length = F.length(text).cast("double")
    numbers = {
        "url_length": length,
        "host_length": F.length(name),
        "path_length": F.length(place),
        "host_labels": F.size(F.split(name, r"\.")),
        "depth": F.length(F.regexp_replace(place, "[^/]+", "")),
        "digit_ratio": F.length(F.regexp_replace(text, "[^0-9]+", "")) / F.greatest(length, F.lit(1.0)),
        "hyphens": F.length(F.regexp_replace(name, "[^-]+", "")),
        "entropy": entropy(text),
        "parameters": F.when(F.length(query) > 0, F.size(F.split(query, "&"))).otherwise(0),
        "fragment": F.contains(text, F.lit("#")),
        "suffix_length": F.length(F.substring_index(name, ".", -1)),
    }
    return {k: v.cast("double") for k, v in numbers.items()}


def judge(
    pages: DataFrame,
    url: str = "url",
    rules=RULES,
    labelled: DataFrame | None = None,
    max_labelled: int = MAX_LABELLED,
) -> DataFrame:
    """``(row, host, path, rule, verdict, blocked)``: the columns of ``pages``
    as the struct ``row``, the longest fitting rule (else null), the verdict
    (the rule's, else the trees': block from a probability of 0.5) and that
    probability. ``labelled`` (url, blocked boolean) trains the trees; without
    it the urls that a rule judges do.

    A null url or one without ``://`` has an empty host and path, fits no rule
    and is judged by the trees. Without labels of both kinds the trees give
    the share of blocked labels, 0 without any. Repeated rows are judged
    alike; an empty table gives no rows; no name of ``pages`` clashes.
    """
    rows = pages.select(F.struct(*(F.col(f"`{c}`") for c in pages.columns)).alias("row"), F.col(f"`{url}`").alias("_url"))
    rows = rows.withColumns({"host": host(F.col("_url")), "path": path(F.col("_url"))})
    rows = rows.withColumn("_rule", rule(F.col("host"), F.col("path"), rules))
    if labelled is None:
        labelled = rows.where("_rule is not null").select(F.col("_url").alias("url"), (F.col("_rule.verdict") == "block").alias("blocked"))
    suffix = F.substring_index(host(F.col("_url")), ".", -1).alias("_suffix")
    labels = written(
        labelled.where("blocked is not null")
        .select(F.col("url").alias("_url"), F.col("blocked").cast("int").alias("_label"))
        .groupBy("_url")
        .agg(F.max("_label").alias("_label")),  # a url that any label blocks is blocked
        "url-labels",
    )
    n, blocked = labels.agg(F.count("*"), F.coalesce(F.sum("_label"), F.lit(0))).first()
    share = blocked / n if n else 0.0
    # By name over all urls and all labels; rows of a suffix are combined in each task.
    of_labels = labels.groupBy(suffix).agg(F.sum("_label").alias("_b"), F.count("*").alias("_l"))
    suffixes = written(rows.groupBy(suffix).agg(F.count("*").alias("_n")).join(of_labels, "_suffix", "full"), "url-suffixes")
    urls = suffixes.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    sample = written(labels.orderBy(F.xxhash64("_url"), "_url").limit(max_labelled).coalesce(2), "url-sample")

    def described(urls_: DataFrame, own: Column | int = 0, of_own: int = 0) -> DataFrame:
        """Features; a training url's ``own`` label is left out of its suffix's."""
        found = urls_.withColumns(lexical(F.col("_url"))).withColumn("_suffix", suffix).join(suffixes, "_suffix", "left")
        b, l, count = (F.coalesce(c, F.lit(0)) for c in ("_b", "_l", "_n"))
        return found.withColumns(
            {
                "suffix_share": count / F.lit(float(max(urls, 1))),
                "suffix_blocked": (b - own + SMOOTHING * share) / (l - of_own + SMOOTHING),
            }
        )

    if 0 < blocked < n:
        model = fit(described(sample, F.col("_label"), 1).coalesce(2), list(FEATURES), "_label", ROUNDS, DEPTH)
        chance = probability(model, lambda i: F.col(FEATURES[i]))
    else:
        chance = F.lit(share)
    judged = described(rows).withColumn("blocked", chance)
    trees = F.when(F.col("blocked") >= 0.5, "block").otherwise("allow")
    return judged.select(
        "row", "host", "path", F.col("_rule.rule").alias("rule"), F.coalesce("_rule.verdict", trees).alias("verdict"), "blocked"
    )

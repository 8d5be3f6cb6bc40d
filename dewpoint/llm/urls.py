"""URL filtering by listed rules and by mined association rules."""

from __future__ import annotations

import string
from dataclasses import dataclass
from math import ceil

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dewpoint.llm.common import BROADCAST_ROWS, kept


@dataclass(frozen=True)
class UrlRule:
    """A verdict for a host with its subdomains, below a path."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return f"{self.host}{self.path}"


def host_of(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def url_tokens(url: Column) -> Column:
    """Distinct letter-digit runs of the lower-cased URL that hold a letter."""
    runs = F.regexp_extract_all(
        F.lower(F.coalesce(url, F.lit(""))), F.lit(r"(\p{L}[\p{L}\p{N}]*)"), 1
    )
    return F.array_distinct(runs)


def listed_rule(host: Column, path: Column, rules: list[UrlRule]) -> Column:
    """The name of the longest rule that fits, else null."""
    chosen = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | F.endswith(host, F.lit(f".{rule.host}"))) & F.startswith(
            path, F.lit(rule.path)
        )
        chosen = F.when(fits, F.lit(rule.name)).otherwise(chosen)
    return chosen


def mine_rules(
    labelled: DataFrame,
    *,
    support: float = 0.002,
    confidence: float = 0.7,
) -> DataFrame:
    """Association rules ``antecedent, verdict, confidence, support`` from ``tokens, verdict``.

    FP-growth finds the tokens frequent together with a verdict; rules below ``support``
    (share of labelled URLs) or ``confidence`` are pruned, and so is a rule that a smaller
    one of the same verdict predicts as well. Support alone bounds the tokens; those of all
    labelled URLs say nothing and are left out. ``antecedent`` is an array of items, the
    rarest first, an item an array of tokens that occur in the same labelled URLs: any one
    of them meets the item.

    Neither merging such tokens nor mining tokens of a single verdict apart loses a rule:
    a token of one verdict alone is a rule of confidence 1 that covers all larger ones.
    """
    labelled = kept(
        labelled.select(F.array_sort("tokens").alias("tokens"), "verdict")
        .groupBy("tokens", "verdict")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    total = labelled.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    blocked = F.sum(F.when(F.col("verdict") == "block", F.col("n")).otherwise(0))
    least = ceil(support * total)
    items = kept(
        labelled.select(
            F.explode("tokens").alias("token"),
            "verdict",
            "n",
            F.xxhash64("tokens", "verdict").alias("hash"),
            F.xxhash64(F.lit("second"), "tokens", "verdict").alias("second"),
        )
        .groupBy("token")
        .agg(
            F.sum("n").alias("n"),
            blocked.alias("blocked"),
            F.bit_xor("hash").alias("hash"),
            F.bit_xor("second").alias("second"),
        )
        .filter((F.greatest("blocked", F.col("n") - F.col("blocked")) >= least) & (F.col("n") < total))
        .groupBy("n", "blocked", "hash", "second")
        .agg(F.array_sort(F.collect_list("token")).alias("members"))
        # Items sort by their number of URLs.
        .withColumn("item", F.concat_ws(" ", F.lpad(F.col("n").cast("string"), 15, "0"), "members"))
    )
    single = (F.col("blocked") == 0) | (F.col("blocked") == F.col("n"))
    pure = items.filter(single).select(
        F.array("item").alias("antecedent"),
        F.when(F.col("blocked") > 0, "block").otherwise("allow").alias("verdict"),
        F.lit(1.0).alias("confidence"),
        (F.col("n") / F.lit(float(max(total, 1)))).alias("support"),
    )
    # Items are at most (tokens of a URL) / support; each is met by its first token.
    mixed = items.filter(~single).select(F.element_at("members", 1).alias("token"), "item")
    baskets = (
        labelled.select("tokens", "verdict", "n", F.explode("tokens").alias("token"))
        .join(F.broadcast(mixed), "token")
        .groupBy("tokens", "verdict", "n")
        .agg(F.collect_set("item").alias("items"))
    )
    baskets = baskets.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n")))).select(
        F.concat("items", F.array(F.concat(F.lit("verdict:"), F.col("verdict")))).alias("items")
    )
    baskets = kept(baskets)
    # URLs without an item count for the support all the same.
    n = baskets.count()
    model = FPGrowth(
        itemsCol="items", minSupport=min(1.0, max(least - 0.5, 0.5) / max(n, 1)), minConfidence=confidence
    ).fit(baskets)
    verdict = F.col("consequent")[0]
    found = kept(
        model.associationRules.filter(F.startswith(verdict, F.lit("verdict:")))
        .filter(~F.exists("antecedent", lambda x: F.startswith(x, F.lit("verdict:"))))
        .select(
            F.array_sort("antecedent").alias("antecedent"),
            F.substring(verdict, len("verdict:") + 1, 10).alias("verdict"),
            "confidence",
            (F.col("support") * F.lit(n / max(total, 1))).alias("support"),
        )
    )
    smaller = found.select(
        F.col("antecedent").alias("part"), "verdict", F.col("confidence").alias("reached")
    )
    # FP-growth has listed every part of a rule already; a rule meets its parts by equality.
    places = F.sequence(F.lit(0), F.size("antecedent") - 1)
    covered = (
        found.filter(F.size("antecedent") > 1)
        .withColumn(
            "mask",
            F.explode(F.sequence(F.lit(1), F.pow(F.lit(2), F.size("antecedent")).cast("int") - 2)),
        )
        .withColumn(
            "part",
            F.transform(
                F.filter(places, lambda i: F.getbit(F.col("mask"), i) == 1),
                lambda i: F.get("antecedent", i),
            ),
        )
        .join(smaller, ["part", "verdict"])
        .filter(F.col("reached") >= F.col("confidence"))
        .select("antecedent", "verdict")
        .distinct()
    )
    rules = found.join(covered, ["antecedent", "verdict"], "left_anti").unionByName(pure)
    members = F.transform("antecedent", lambda item: F.slice(F.split(item, " "), 2, 1_000_000))
    return rules.withColumn("antecedent", members)


def match_mined(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """``pages`` (with ``tokens``) and a column ``mined``: the verdict of the surest rule, or null.

    Each distinct set of tokens meets the rules through an inverted index: its tokens join
    the tokens of the rules' rarest items, and a rule fires if all its items were met. The
    surest rule wins, then the one of more items, then block over allow.
    """
    index = kept(
        rules.select(
            F.explode(F.get("antecedent", F.lit(0))).alias("token"),
            "antecedent",
            "verdict",
            "confidence",
        )
    )
    if index.count() <= BROADCAST_ROWS:
        index = F.broadcast(index)
    signed = pages.withColumn("_signature", F.array_join(F.array_sort("tokens"), " "))
    fired = (
        signed.select("_signature")
        .distinct()
        .withColumn("_met", F.split("_signature", " "))
        .withColumn("token", F.explode("_met"))
        .join(index, "token")
        .filter(F.forall("antecedent", lambda item: F.arrays_overlap(item, F.col("_met"))))
    )
    surest = fired.groupBy("_signature").agg(
        F.max(
            F.struct(
                "confidence",
                F.size("antecedent").alias("needed"),
                (F.col("verdict") == "block").alias("block"),
            )
        ).alias("best")
    )
    mined = kept(
        surest.select(
            "_signature", F.when(F.col("best.block"), "block").otherwise("allow").alias("mined")
        )
    )
    if mined.count() <= BROADCAST_ROWS:
        mined = F.broadcast(mined)
    return signed.join(mined, "_signature", "left").drop("_signature")


def judge_urls(
    pages: DataFrame,
    rules: list[UrlRule],
    *,
    id_column: str = "page_id",
    url: str = "url",
    support: float = 0.002,
    confidence: float = 0.7,
) -> DataFrame:
    """A verdict per page: ``page_id, host, path, rule, verdict, mined``.

    A listed rule decides where one fits. The URLs it covers are the labelled examples
    from which token rules are mined; these judge the URLs no listed rule covers, and a
    URL that no rule covers is allowed. ``mined`` is what the mined rules alone say (null:
    nothing). A null URL or one without ``://`` has an empty host and path and is covered
    by no listed rule. Repeated pages are judged alike; without pages there are no rows.
    Other columns are not read.
    """
    verdicts = {rule.name: rule.verdict for rule in rules}
    parsed = pages.select(
        F.col(id_column).alias("page_id"),
        host_of(F.col(url)).alias("host"),
        path_of(F.col(url)).alias("path"),
        url_tokens(F.col(url)).alias("tokens"),
    ).withColumn("rule", listed_rule(F.col("host"), F.col("path"), rules))
    listed = F.lit(None).cast("string")
    for name, verdict in verdicts.items():
        listed = F.when(F.col("rule") == name, F.lit(verdict)).otherwise(listed)
    labelled = parsed.select("tokens", listed.alias("verdict")).filter("verdict IS NOT NULL")
    mined = mine_rules(labelled, support=support, confidence=confidence)
    return match_mined(parsed, mined).select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce(listed, F.col("mined"), F.lit("allow")).alias("verdict"),
        "mined",
    )

"""URL filter by association rules.

A URL is the set of its host's and path's tokens. FP-growth mines the token combinations of labelled URLs; those that
imply "block" with enough confidence and support become rules, and a rule that a shorter one makes superfluous is
pruned. Tokens that always stand together, like the parts of a site's template, are mined as one item. Rules are indexed by their rarest token: a URL meets the rules of its tokens by a join and keeps those whose
tokens it has all. Given prefix rules decide first; the longest wins.

Null URLs and URLs without :// have empty host and path and no tokens: the mined rules never block them. Repeated
URLs are matched once and judged alike. Without labels no rule is mined and the rest is allowed. Columns other than
page_id and url are not carried.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import LOWER, UPPER, staged

# Prefix rules and their verdicts, longest match wins.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))

# Host words that mark a URL as bad when no label says more.
SEEDS = ("adult", "ads", "bets", "casino", "pills", "spam")

BLOCK, SUPPORT, EXAMPLES, CONFIDENCE = "label=block", 0.002, 5, 0.8


def host(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens(host_column: Column, path_column: Column) -> Column:
    """Distinct tokens: h:... of the host's labels and their words, p:... of the path's parts."""
    labels = F.split(host_column, r"\.")
    parts = F.array_union(labels, F.flatten(F.transform(labels, lambda x: F.split(x, "-"))))
    places = F.split(path_column, r"[/.]")
    named = F.concat(F.transform(parts, lambda x: F.concat(F.lit("h:"), x)), F.transform(places, lambda x: F.concat(F.lit("p:"), x)))
    return F.array_distinct(F.filter(named, lambda x: F.length(x) > 2))


def prefix_rule(host_column: Column, path_column: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    """The longest rule (host/path) whose host is the URL's or a parent domain of it, and whose path begins the URL's."""
    out = F.lit(None).cast("string")
    for rule in sorted((r for r, _ in rules), key=len):
        domain, slash, rest = rule.partition("/")
        fits = ((host_column == domain) | F.endswith(host_column, F.lit("." + domain))) & F.startswith(path_column, F.lit(slash + rest))
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def labelled(pages: DataFrame, labels: DataFrame, seeds: tuple[str, ...] = SEEDS) -> DataFrame:
    """tokens and bad of the pages that a label or a seed word speaks about.

    Bad are pages labelled toxic or of low quality, and pages whose host has a seed word.
    """
    marks = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max((F.coalesce("toxic", F.lit(0)) == 1) | (F.coalesce("quality", F.lit(1)) == 0)).alias("_bad"))
    found = pages.select(F.col("page_id").alias("doc_id"), tokens(host(F.col("url")), path(F.col("url"))).alias("tokens"))
    seeded = F.arrays_overlap("tokens", F.array(*(F.lit(f"h:{s}") for s in seeds)))
    return found.join(marks, "doc_id", "left").where(F.col("_bad").isNotNull() | seeded).select("tokens", (seeded | F.coalesce("_bad", F.lit(False))).alias("bad"))


def classes_of_tokens(transactions: DataFrame, need: int) -> DataFrame:
    """One row per class of tokens that stand in exactly the same URLs: members (sorted), n and n_bad.

    Tokens with fewer than `need` bad URLs are left out: no rule can hold them. URLs are compared by two 64-bit sums
    over their row numbers, so that counts and sums are combined before they move.
    """
    row = transactions.select(F.explode("tokens").alias("token"), "bad", F.xxhash64("_row").alias("_a"), F.xxhash64(F.lit("again"), "_row").alias("_b"))
    counted = row.groupBy("token").agg(
        F.count("*").alias("n"), F.count_if("bad").alias("n_bad"), F.sum(F.col("_a").cast("decimal(38,0)")).alias("_a"), F.bit_xor("_b").alias("_b")
    )
    # a class holds no more tokens than one URL
    return counted.where(F.col("n_bad") >= need).groupBy("n", "n_bad", "_a", "_b").agg(F.array_sort(F.collect_list("token")).alias("members")).select("members", "n", "n_bad")


def class_rules(examples: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """Rules (antecedent, confidence, support, keys) that imply block. A rule needs the support as a share, and `EXAMPLES` URLs at least.

    An antecedent is a list of classes; a URL meets it if it has a token of each. Tokens of one class stand in the same
    labelled URLs, so that each in place of another makes an equally sure rule, and two of them no surer one: they are
    mined as one item. A class whose URLs are all bad is a rule by itself that no longer rule betters, and one that is in
    all URLs adds nothing to another; neither is mined further. The keys are the tokens of the rarest class.
    """
    transactions = staged(examples.where("size(tokens) > 0").withColumn("_row", F.monotonically_increasing_id()), "url_tokens")
    total = transactions.count()
    need = math.ceil(max(support, EXAMPLES / max(total, 1)) * total)
    classes = staged(classes_of_tokens(transactions, max(need, 1)).withColumn("item", F.element_at("members", 1)), "url_classes")
    sure = F.col("n_bad") / F.col("n")
    single = classes.where(sure >= confidence).select(F.array("item").alias("items"), sure.alias("confidence"), (F.col("n_bad") / F.lit(max(total, 1))).alias("support"))
    mixed = classes.where((F.col("n_bad") < F.col("n")) & (F.col("n") < total))
    given = transactions.select("_row", "bad", F.explode("tokens").alias("item")).join(mixed.select("item"), "item")
    rows = staged(given.groupBy("_row", "bad").agg(F.collect_list("item").alias("items")).select(F.when(F.col("bad"), F.concat("items", F.array(F.lit(BLOCK)))).otherwise(F.col("items")).alias("items")), "url_items")
    left = rows.count()
    rules = single
    if left >= need and left > 0:
        model = FPGrowth(minSupport=(need - 0.5) / left, minConfidence=confidence).fit(rows)
        longer = model.associationRules.where((F.col("consequent") == F.array(F.lit(BLOCK))) & (F.size("antecedent") > 1))
        rules = single.union(longer.select(F.array_sort("antecedent"), "confidence", F.col("support") * left / total))
    rules = staged(rules, "url_rules")
    member = rules.where("size(items) > 1").select(F.explode("items").alias("token"), F.col("items").alias("longer"))
    shorter = rules.select(F.element_at("items", 1).alias("token"), F.col("items").alias("shorter"), F.col("confidence").alias("_c"))
    superfluous = (
        member.join(shorter, "token")
        .where((F.size("shorter") < F.size("longer")) & (F.size(F.array_except("shorter", "longer")) == 0))
        .groupBy(F.col("longer").alias("items"))
        .agg(F.max("_c").alias("_best"))
    )
    pruned = rules.join(superfluous, "items", "left").where(F.col("_best").isNull() | (F.col("confidence") > F.col("_best"))).drop("_best")
    named = pruned.withColumn("item", F.explode("items")).join(classes.select("item", "members", "n"), "item")
    spelled = named.groupBy("items", "confidence", "support").agg(F.array_sort(F.collect_list("members")).alias("antecedent"), F.min(F.struct("n", "members"))["members"].alias("keys"))
    return staged(spelled.select("antecedent", "confidence", "support", "keys"), "url_index")


def mine(examples: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """The rules spelled out: (antecedent, confidence, support, key) for every choice of one token from each class."""
    rules = class_rules(examples, support, confidence)
    place = F.array_position("antecedent", F.col("keys")).cast("int")
    every = F.aggregate("antecedent", F.array(F.array().cast("array<string>")), lambda done, members: F.flatten(F.transform(done, lambda x: F.transform(members, lambda y: F.concat(x, F.array(y))))))
    spelled = rules.select(F.explode(every).alias("_chosen"), "confidence", "support", place.alias("_at"))
    return spelled.select(F.array_sort("_chosen").alias("antecedent"), "confidence", "support", F.element_at("_chosen", F.col("_at")).alias("key"))


def blocked(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The distinct URLs that meet one of `class_rules`, with the surest one: url, mined, confidence."""
    found = urls.where("url IS NOT NULL").select("url").distinct().withColumn("tokens", tokens(host(F.col("url")), path(F.col("url"))))
    keyed = rules.withColumn("key", F.explode("keys")).drop("keys")
    hits = found.withColumn("key", F.explode("tokens")).join(keyed, "key").where(F.forall("antecedent", lambda members: F.arrays_overlap(members, F.col("tokens"))))
    mined = F.concat_ws(" ", F.transform("antecedent", lambda members: F.concat_ws("|", members)))
    best = F.max(F.struct("confidence", "support", mined.alias("mined")))
    return hits.groupBy("url").agg(best.alias("best")).select("url", F.col("best.mined"), F.col("best.confidence"))


def judge(pages: DataFrame, labels: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, support: float = SUPPORT, confidence: float = CONFIDENCE, seeds: tuple[str, ...] = SEEDS) -> DataFrame:
    """page_id, host, path, rule, verdict, and the mined rule and its confidence where one blocks."""
    mined = blocked(pages, class_rules(labelled(pages, labels, seeds), support, confidence))
    verdicts = F.create_map(*(F.lit(x) for rule in rules for x in rule))
    judged = pages.select("page_id", "url").join(mined, "url", "left").withColumns({"host": host(F.col("url")), "path": path(F.col("url"))})
    judged = judged.withColumn("rule", prefix_rule(F.col("host"), F.col("path"), rules))
    own = F.when(F.col("mined").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return judged.withColumn("verdict", F.coalesce(F.element_at(verdicts, F.col("rule")), own)).select("page_id", "host", "path", "rule", "verdict", "mined", "confidence")

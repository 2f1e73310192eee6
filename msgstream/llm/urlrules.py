"""URL filtering by listed rules and by association rules mined from labelled URLs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgstream.scratch import stored

# Listed rules as host, start of path, verdict.
LISTED = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
DEFAULT = "allow"

# A combination must stand in this share of the labelled URLs, and this share of those that hold it must bear
# the label. The first also bounds the mined rules and their tokens, whatever the input.
LEAST_SUPPORT = 0.01
LEAST_CONFIDENCE = 0.9

# Sets of rule tokens that are sent to every task; of more, each is sent to so many parts of its pages.
FEW_SETS, PARTS = 20_000, 32

_LABEL = "label="
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class UrlParts:
    host: Column
    path: Column
    rest: Column


def parts(url: Column) -> UrlParts:
    """Host, lower case in A to Z, path, and what follows the path. All empty without ``://``."""
    at = F.instr(url, "://")
    after = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(after, r"^[^/?#]*", 0)
    beyond = F.substring(after, F.length(host) + 1, F.length(after))
    path = F.regexp_extract(beyond, r"^[^?#]*", 0)
    rest = F.substring(beyond, F.length(path) + 1, F.length(beyond))
    empty = F.lit("")
    return UrlParts(F.coalesce(F.translate(host, _UPPER, _LOWER), empty), F.coalesce(path, empty), F.coalesce(rest, empty))


def listed_rule(host: Column, path: Column, rules: tuple = LISTED) -> tuple[Column, Column]:
    """The longest listed rule that fits, and its verdict; NULL where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, start, decision in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        rule, verdict = F.when(fits, name + start).otherwise(rule), F.when(fits, decision).otherwise(verdict)
    return rule, verdict


def tokens(p: UrlParts) -> Column:
    """Distinct tokens of a URL: the host and the domains above it, folders and ending of the path, query keys."""
    labels = F.split(p.host, r"\.")
    n = F.size(labels)
    domains = F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.lit("host="), F.array_join(F.slice(labels, i, n), ".")))
    first = F.concat(F.lit("sub="), F.element_at(labels, 1))
    folders = F.transform(F.filter(F.split(p.path, "/"), lambda s: s != ""), lambda s: F.concat(F.lit("dir="), s))
    ending = F.concat(F.lit("end="), F.regexp_extract(p.path, r"(\.\w{1,8}|/)$", 1))
    query = F.regexp_extract(p.rest, r"^\?([^#]*)", 1)
    keys = F.transform(F.filter(F.split(query, "&"), lambda s: s != ""), lambda s: F.concat(F.lit("key="), F.substring_index(s, "=", 1)))
    anchor = F.filter(F.array(F.when(p.rest.contains("#"), F.lit("anchor"))), lambda x: x.isNotNull())
    every = F.concat(domains, F.array(first, ending), folders, keys, anchor)
    return F.when(p.host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(every))


def always_together(labelled: DataFrame, least_support: float = LEAST_SUPPORT) -> dict[str, str]:
    """For each token that stands in exactly the same labelled URLs as another, the least of these; of ``tokens, label``.

    The tokens of one site's pages often come all together, and k such tokens would be 2^k frequent combinations that
    all say the same. Sets of URLs are compared by their size and two sums of hashes. Only tokens of enough support
    are looked at, so the result is as bounded as the mined rules are.
    """
    rows = stored(labelled.select(F.monotonically_increasing_id().alias("url"), "tokens"), "url-tokens")
    least = least_support * rows.count()
    each = rows.select("url", F.explode("tokens").alias("token"))
    first, second = (F.bit_xor(F.xxhash64(F.lit(seed), "url")) for seed in (1, 2))
    stood = each.groupBy("token").agg(F.count("*").alias("n"), first.alias("a"), second.alias("b")).where(F.col("n") >= least)
    alike = stood.groupBy("n", "a", "b").agg(F.min("token").alias("least"), F.collect_list("token").alias("tokens"))
    pairs = alike.where(F.size("tokens") > 1).select("least", F.explode("tokens").alias("token")).where("token <> least")
    return {row["token"]: row["least"] for row in pairs.collect()}


def represented(tokens: Column, least: dict[str, str]) -> Column:
    """Tokens with the least of those that always come together in place of each of them."""
    if not least:
        return tokens
    names, others = (F.array(*[F.lit(t) for t in side]) for side in (list(least), list(least.values())))
    return F.array_distinct(F.transform(tokens, lambda t: F.coalesce(F.get(others, F.array_position(names, t).cast("int") - 1), t)))


def mined_rules(
    labelled: DataFrame, least_support: float = LEAST_SUPPORT, least_confidence: float = LEAST_CONFIDENCE
) -> DataFrame:
    """``rule_id, items, verdict, confidence, support`` from ``tokens, label``.

    Frequent combinations come from FP-growth over all labelled URLs. Rules lead from tokens to a label, and a
    rule goes if leaving out one of its tokens gives a rule of the same label that is as sure.
    """
    spark = labelled.sparkSession
    empty = "rule_id long, items array<string>, verdict string, confidence double, support double"
    baskets = labelled.select(F.concat("tokens", F.array(F.concat(F.lit(_LABEL), F.col("label")))).alias("items"))
    baskets = stored(baskets, "url-baskets")
    if baskets.isEmpty():
        return spark.createDataFrame([], empty)
    model = FPGrowth(itemsCol="items", minSupport=least_support, minConfidence=least_confidence).fit(baskets)
    label = F.element_at("consequent", 1)
    rules = model.associationRules.where(label.startswith(_LABEL)).where(
        ~F.exists("antecedent", lambda x: x.startswith(_LABEL))
    )
    rules = rules.select(
        F.array_sort("antecedent").alias("items"),
        F.substring(label, len(_LABEL) + 1, 100).alias("verdict"),
        "confidence",
        "support",
    )
    rules = stored(rules, "url-rules")
    shorter = rules.where(F.size("items") > 1).select(
        "items", "verdict", "confidence", F.explode("items").alias("less")
    ).select("items", "verdict", "confidence", F.array_remove("items", F.col("less")).alias("general"))
    general = rules.select(F.col("items").alias("general"), "verdict", F.col("confidence").alias("sure"))
    needless = shorter.join(general, ["general", "verdict"]).where(F.col("sure") >= F.col("confidence"))
    kept = rules.join(needless.select("items", "verdict"), ["items", "verdict"], "left_anti")
    return stored(kept.select(F.xxhash64("items", "verdict").alias("rule_id"), "items", "verdict", "confidence", "support"), "url-kept")


def matched(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """``known, mined`` of the distinct token sets ``known`` that hold all tokens of a rule.

    An inverted index leads from a token to the rules with it; a rule fits a set that meets it as often as it
    has tokens. The surest fitting rule decides, then that of more support, then blocking.
    """
    index = rules.select(F.explode("items").alias("token"), "rule_id", F.size("items").alias("needed"))
    met = sets.select("known", F.explode("known").alias("token")).join(index, "token")
    fits = met.groupBy("known", "rule_id", "needed").agg(F.count("*").alias("found")).where("found = needed")
    scored = fits.join(rules.select("rule_id", "verdict", "confidence", "support"), "rule_id")
    order = F.struct("confidence", "support", (F.col("verdict") == "block").alias("blocks"), "verdict")
    return scored.groupBy("known").agg(F.max(order).alias("best")).select("known", F.col("best.verdict").alias("mined"))


def judged(
    pages: DataFrame, rules: tuple = LISTED, default: str = DEFAULT, least_support: float = LEAST_SUPPORT,
    least_confidence: float = LEAST_CONFIDENCE,
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every page.

    The longest listed rule that fits a URL decides. URLs so decided are the labels from which token
    combinations are mined; what no listed rule fits gets the verdict of the surest mined rule, or
    ``default``. All of it is DataFrame and SQL work. URLs are reduced to the tokens of mined rules, whose
    number the least support bounds, and only distinct sets of those are matched, so a host with a third of
    all pages is a few rows. Tokens that always stand together count as one (:func:`always_together`); a URL with any
    of them fits. Verdicts go back to the pages by broadcast where there are at most ``FEW_SETS`` of them; else
    the pages of a set are dealt over ``PARTS`` parts, each of which gets them.

    A NULL URL, and one without ``://``, has an empty host and path and gets the default. Repeated rows are
    judged alike; no rows give none; extra columns are not read. A URL of any length is read whole.
    """
    p = parts(F.col("url"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), p.host.alias("host"), p.path.alias("path"), p.rest.alias("rest"))
    rule, verdict = listed_rule(F.col("host"), F.col("path"), rules)
    held = tokens(UrlParts(F.col("host"), F.col("path"), F.col("rest")))
    rows = rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("listed"), held.alias("tokens"))
    labelled = rows.where("listed IS NOT NULL").select("tokens", F.col("listed").alias("label"))
    least = always_together(labelled, least_support)
    labelled = labelled.withColumn("tokens", represented(F.col("tokens"), least))
    mined = mined_rules(labelled, least_support, least_confidence)
    vocabulary = sorted(row["token"] for row in mined.select(F.explode("items").alias("token")).distinct().collect())
    # Bounded by the least support: at most (tokens of a URL) / support of them.
    words = F.array(*[F.lit(t) for t in vocabulary]) if vocabulary else F.array().cast("array<string>")
    known = F.when(F.col("listed").isNull(), F.array_sort(F.array_intersect(represented(F.col("tokens"), least), words)))
    rows = rows.withColumn("known", known).drop("tokens")
    sets = rows.where(F.size("known") > 0).select("known").distinct()
    found = stored(matched(sets, mined), "url-matched")
    if found.count() <= FEW_SETS:
        decided = rows.join(F.broadcast(found), "known", "left")
    else:
        part = F.pmod(F.xxhash64("page_id", "host", "path"), F.lit(PARTS))
        spread = found.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(PARTS - 1).cast("long"))))
        decided = rows.withColumn("part", part).join(spread, ["known", "part"], "left")
    return decided.select("page_id", "host", "path", "rule", F.coalesce("listed", "mined", F.lit(default)).alias("verdict"))

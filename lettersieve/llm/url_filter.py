"""URL filter: listed rules first, then the ratio of two character language models.

Accepted and rejected URLs (by the rules) train one variable-order Markov model each over the
characters of host and path. A model of order k mixes the counts of a context of k characters
with the model of order k - 1 by Witten-Bell smoothing: contexts with many different
followers trust the shorter context more, unseen contexts pass it on unchanged, and order -1
is uniform. A URL's score is the difference of its log-likelihoods, rejected minus
accepted, divided by its number of characters. URLs in a held-out fold, which trains nothing,
calibrate the cutoff: at most ``FALSE_BLOCK`` of the held-out accepted URLs lie above it.

The models are tables: one count table of grams of ``ORDER + 1`` characters over all URLs, from
which all shorter contexts follow by sums, so texts are expanded once; probabilities are
joined level by level. Grams that are very frequent in URLs, at most ``HOT_SHARE`` by
count, are joined by a broadcast of proven size, the others by a shuffle.

Defined results: a null URL or one without ``://`` has empty host and path, no rule, and is
blocked. A URL that no model can judge, because one class has no URL to learn from, is allowed.
Repeated URLs are scored once. Very long URLs are expanded character by character like others.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettersieve.llm.common import HOT_SHARE, let
from lettersieve.sources.shared import stored

ORDER = 4
ALPHABET = 256
FOLDS = 5
FALSE_BLOCK = 0.05
BINS = 1000
START, END = "\x02", "\x03"


@dataclass(frozen=True)
class Rule:
    """Allows or blocks a host with its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The listed rules.
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def ruled(pages: DataFrame, rules: tuple[Rule, ...] = RULES, url: str = "url", key: str = "page_id") -> DataFrame:
    """(page_id, host, path, rule, listed): the longest rule that fits, and its verdict."""
    urls = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"))
    host, path = host_and_path(F.col("url"))
    parts = urls.select("page_id", F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))
    rule, listed = F.lit(None).cast("string"), F.lit(None).cast("string")
    # Later branches of when() are tried later: longest first.
    for r in sorted(rules, key=lambda r: len(r.text)):
        fits = ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path)
        rule, listed = F.when(fits, F.lit(r.text)).otherwise(rule), F.when(fits, F.lit(r.verdict)).otherwise(listed)
    return parts.select("*", rule.alias("rule"), listed.alias("listed"))


def address(host: str = "host", path: str = "path") -> Column:
    return F.concat(host, path)


def held_out(name: Column) -> Column:
    return F.pmod(F.xxhash64(name, F.lit("fold")), F.lit(FOLDS)) == 0


def grams(name: Column, order: int = ORDER) -> Column:
    """All grams of order + 1 characters of a string, one per character and one for its end."""
    split = F.filter(F.split(F.concat(F.lit(START * order), name, F.lit(END)), ""), lambda c: c != "")

    def picked(chars: Column) -> Column:
        # By position: a slice would copy the whole array for every gram.
        at = F.sequence(F.lit(0), F.size(chars) - order - 1)
        return F.transform(at, lambda i: F.concat(*[F.get(chars, i + k) for k in range(order + 1)]))

    return let(split, picked)


def gram_counts(urls: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, accepted, rejected, n): occurrences in URLs to learn from, and in all.

    ``urls`` has (name, n, accepted, rejected): distinct strings with their numbers of rows.
    """
    return (
        urls.select(F.explode(grams(F.col("name"), order)).alias("gram"), "n", "accepted", "rejected")
        .groupBy("gram")
        .agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"), F.sum("n").alias("n"))
    )


def probabilities(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, accepted, rejected): log-probability of each gram's last character after the others."""
    classes = ("accepted", "rejected")
    levels = [counts]
    for k in range(order - 1, -1, -1):
        shorter = F.expr(f"right(gram, {k + 1})")
        above = levels[-1]
        levels.append(
            above.groupBy(shorter.alias("gram")).agg(*[F.sum(c).alias(c) for c in classes])
        )
    lower: DataFrame | None = None
    for k, level in enumerate(reversed(levels)):
        level = level.select("gram", *classes, F.expr(f"left(gram, {k})").alias("context"))
        totals = level.groupBy("context").agg(
            *[F.sum(c).alias(f"{c}_all") for c in classes],
            *[F.sum(F.when(F.col(c) > 0, 1).otherwise(0)).alias(f"{c}_kinds") for c in classes],
        )
        joined = level.join(totals, "context")
        if lower is None:
            joined = joined.withColumns({f"{c}_low": F.lit(1.0 / ALPHABET) for c in classes})
        else:
            below = lower.select(F.col("gram").alias("short"), *[F.col(c).alias(f"{c}_low") for c in classes])
            joined = joined.withColumn("short", F.expr(f"right(gram, {k})")).join(below, "short")

        def mixed(c: str) -> Column:
            weight = F.col(f"{c}_all") + F.col(f"{c}_kinds")
            own = (F.col(c) + F.col(f"{c}_kinds") * F.col(f"{c}_low")) / weight
            return F.when(weight > 0, own).otherwise(F.col(f"{c}_low")).alias(c)

        lower = stored(joined.select("gram", *[mixed(c) for c in classes]), f"markov-{k}")
    return lower.select("gram", *[F.log(c).alias(c) for c in classes])


def scored(names: DataFrame, counts: DataFrame, model: DataFrame, order: int = ORDER) -> DataFrame:
    """(name, score) of distinct strings ``names(name)``: rejected minus accepted, per character."""
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = counts.filter(F.col("n") > total / HOT_SHARE).select("gram")
    ratio = model.select("gram", (F.col("rejected") - F.col("accepted")).alias("ratio"))
    frequent = stored(ratio.join(hot, "gram", "left_semi"), "hot-grams").withColumnRenamed("ratio", "known")
    rare = ratio.join(hot, "gram", "left_anti")
    rows = names.select("name", F.explode(grams(F.col("name"), order)).alias("gram")).join(
        F.broadcast(frequent), "gram", "left"
    )
    quick = rows.filter("known is not null").select("name", "known")
    slow = rows.filter("known is null").join(rare, "gram").select("name", F.col("ratio").alias("known"))
    return quick.union(slow).groupBy("name").agg((F.sum(F.round("known", 9).cast("decimal(18,9)")).cast("double") / F.count("*")).alias("score"))


def threshold(scores: DataFrame, false_block: float = FALSE_BLOCK) -> float:
    """The lowest cutoff above which at most ``false_block`` of the rows (score, n) lie.

    Scores are counted in bins of 1 / BINS, a bounded number.
    """
    bins = scores.groupBy(F.ceil(F.col("score") * BINS).alias("bin")).agg(F.sum("n").alias("n")).collect()
    allowed, above = false_block * sum(b["n"] for b in bins), 0
    for b in sorted(bins, key=lambda b: -b["bin"]):
        above += b["n"]
        if above > allowed:
            return b["bin"] / BINS
    return float("inf")


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, url: str = "url", key: str = "page_id") -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of every row of ``pages``.

    Rows with a rule take its verdict; their score is null unless they are in the held-out fold.
    """
    rows = stored(ruled(pages, rules, url, key).withColumn("name", address()), "urls")
    learn = ~held_out(F.col("name"))
    urls = stored(
        rows.filter("name != ''")
        .groupBy("name")
        .agg(
            F.count("*").alias("n"),
            F.sum(F.when(learn & (F.col("listed") == "allow"), 1).otherwise(0)).alias("accepted"),
            F.sum(F.when(learn & (F.col("listed") == "block"), 1).otherwise(0)).alias("rejected"),
            F.sum(F.when(~learn & (F.col("listed") == "allow"), 1).otherwise(0)).alias("held"),
            F.max(F.col("listed").isNull()).alias("open"),
        ),
        "url-names",
    )
    counts = stored(gram_counts(urls), "url-grams")
    scores = stored(
        scored(urls.filter(F.col("open") | (F.col("held") > 0)).select("name"), counts, probabilities(counts)),
        "url-scores",
    )
    learned = urls.agg(F.coalesce(F.sum("accepted"), F.lit(0)), F.coalesce(F.sum("rejected"), F.lit(0))).first()
    held = scores.join(urls.filter("held > 0").select("name", F.col("held").alias("n")), "name")
    limit = threshold(held) if min(learned) > 0 else float("inf")
    by_model = F.when(F.col("name") == "", "block").when(F.col("score") > limit, "block").otherwise("allow")
    return rows.join(scores, "name", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("listed", by_model).alias("verdict"), "score"
    )


def digest(pages: DataFrame) -> DataFrame:
    return judge(pages)

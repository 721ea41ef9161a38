"""URL verdicts: a rule list, then association rules mined from labelled URLs, with built-in functions only.

Token combinations of any length that occur with enough bad labels are grown token by token, and those
with mostly bad ones are rules. A combination is dropped if fewer of its tokens say as much. The rest is
matched through an inverted index
that lists each combination under its rarest token; the other tokens are then looked up in the URL's own
token list, so a token that most URLs have finds nothing by itself.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trendloom.llm.shared import ascii_lower, cores, written

# (verdict, host, path); fixed values of the query's contract.
RULES = (
    ("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"),
)
# Fewer bad URLs than this show nothing; as many do, however many URLs there are.
MIN_COUNT = 5
MIN_CONFIDENCE = 0.8
# The lower end of the confidence (Wilson, 95 %) must lie above the share of bad URLs, or this if that is less.
LEAST_SURE, Z = 0.5, 1.96
# Rows with the same combination are dealt to so many tasks.
SALTS = 32


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(ascii_lower(rest), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column) -> Column:
    """The longest rule that fits host and path as (rule, verdict), or null."""
    longest = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in reversed(longest):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        chosen = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def url_tokens(url: Column) -> Column:
    """Distinct tokens: parts of the host by place from its end, parts of the path, names in the query."""
    host = F.reverse(F.split(host_of(url), r"\."))
    hosts = F.transform(host, lambda part, k: F.concat(F.lit("h"), k.cast("string"), F.lit(":"), part))
    paths = F.transform(F.split(ascii_lower(path_of(url)), "[/.]"), lambda part: F.concat(F.lit("p:"), part))
    names = F.transform(
        F.regexp_extract_all(F.regexp_extract(url, r"(?s)\?([^#]*)", 1), F.lit("(?:^|&)([^=&]+)"), F.lit(1)),
        lambda part: F.concat(F.lit("q:"), part),
    )
    filled = F.filter(F.concat(hosts, paths, names), lambda t: ~t.rlike(r"^\w+:$"))
    return F.coalesce(F.array_distinct(filled), F.array().cast("array<string>"))


def labelled_tokens(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(tokens, bad) of every labelled page row. A document with any bad label row is bad."""
    bad = labels.groupBy(F.col("doc_id").cast("bigint").alias("_label_id")).agg(
        F.max(F.coalesce((F.col("quality") == 0) | (F.col("toxic") == 1), F.lit(False))).alias("bad")
    )
    return (
        pages.where(F.col("url").isNotNull()).join(bad, F.col("page_id") == F.col("_label_id"))
        .select(url_tokens(F.col("url")).alias("tokens"), "bad")
    )


def surely(bad: Column, n: Column) -> Column:
    """The lower end of the Wilson interval of bad / n."""
    share, z = bad / n, F.lit(Z)
    return (share + z * z / (2 * n) - z * F.sqrt(share * (1 - share) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def mine_rules(
    labelled: DataFrame, min_support: float = 0.0, min_count: int = MIN_COUNT, min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """(rule_tokens, confidence, support) of the combinations that stand for a bad label.

    Combinations grow by one token per round. Not grown, as nothing surer comes of them: combinations with
    too few bad URLs, those with bad URLs only, and those that fewer of their tokens already choose the
    same URLs as (the fewer tokens are then as sure, with any further token too). ``min_support``, a share
    of the labelled URLs, can only raise the least number of bad URLs.
    """
    tasks = cores(labelled)
    merged = labelled.groupBy(F.array_sort("tokens").alias("tokens")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("bad").cast("bigint")).alias("bad")
    )
    urls = written(merged.withColumn("row", F.monotonically_increasing_id()), tasks)
    rows, bad_rows = urls.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("bad"), F.lit(0))).first()
    if not bad_rows:
        return labelled.sparkSession.createDataFrame([], "rule_tokens array<string>, confidence double, support double")
    least = max(min_count, math.ceil(min_support * rows), 1)
    sure = F.col("bad") / F.col("n")
    fits = (sure >= min_confidence) & (surely(F.col("bad"), F.col("n")) > min(LEAST_SURE, bad_rows / rows))
    counts = (F.sum("n").alias("n"), F.sum("bad").alias("bad"))

    def judged(combinations: DataFrame) -> DataFrame:
        """Add ``best``, the confidence of the surest rule among a combination and its parts."""
        known = F.coalesce("parts_best", F.lit(0.0))
        return written(combinations.withColumn("best", F.when(fits, F.greatest(sure, known)).otherwise(known)), tasks)

    def held_by(found: DataFrame, grown: DataFrame) -> DataFrame:
        """(row, part) for the combinations among ``grown`` that can grow on."""
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
        open_ones = grown.where("bad < n").select("part", salts)
        salted = found.select("row", "part", F.pmod("row", F.lit(SALTS)).cast("int").alias("salt"))
        return written(salted.join(open_ones, ["part", "salt"]).select("row", "part"), tasks)

    found = urls.select("row", "n", "bad", F.explode("tokens").alias("token")).withColumn("part", F.array("token"))
    grown = judged(
        found.groupBy("part").agg(*counts).where(F.col("bad") >= least).withColumn("parts_best", F.lit(None).cast("double"))
    )
    levels, holders = [grown], held_by(found, grown)
    tokens = holders.groupBy("row").agg(F.collect_list(F.col("part")[0]).alias("tokens"))
    urls = written(urls.select("row", "n", "bad").join(tokens, "row"), tasks)
    while not holders.isEmpty():
        longer = F.explode(F.filter("tokens", lambda t: t > F.element_at("part", -1)))
        found = holders.join(urls, "row").select("row", "n", "bad", "part", longer.alias("token"))
        found = found.select("row", "n", "bad", F.concat("part", F.array("token")).alias("part"))
        counted = written(found.groupBy("part").agg(*counts).where(F.col("bad") >= least), tasks)
        # Every combination with one token less must be there, choose more URLs, and be able to grow.
        without = F.transform("part", lambda t: F.filter("part", lambda other: other != t))
        before = grown.where("bad < n").select(F.col("part").alias("less"), F.col("n").alias("less_n"), F.col("best").alias("less_best"))
        checked = (
            counted.select("part", "n", "bad", F.explode(without).alias("less")).join(before, "less")
            .groupBy("part", "n", "bad").agg(F.count(F.lit(1)).alias("parts"), F.min("less_n").alias("less_n"), F.max("less_best").alias("parts_best"))
            .where((F.col("parts") == F.size("part")) & (F.col("less_n") > F.col("n")))
        )
        grown = judged(checked.select("part", "n", "bad", "parts_best"))
        levels.append(grown)
        holders = held_by(found, grown)
    rules = reduce(DataFrame.unionAll, levels).where(fits & (sure > F.coalesce("parts_best", F.lit(0.0))))
    return rules.select(F.col("part").alias("rule_tokens"), sure.alias("confidence"), (F.col("bad") / rows).alias("support"))


def matched_urls(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The distinct values of ``url`` that hold all tokens of some rule."""
    tokens = urls.where(F.col("url").isNotNull()).select("url").distinct().withColumn("tokens", url_tokens(F.col("url")))
    parts = rules.select("rule_tokens", F.explode("rule_tokens").alias("token"))
    counts = (
        tokens.select(F.explode("tokens").alias("token")).join(parts.select("token").distinct(), "token", "left_semi")
        .groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    )
    rarest = Window.partitionBy("rule_tokens").orderBy(F.coalesce("n", F.lit(0)), "token")
    index = (
        parts.join(counts, "token", "left").withColumn("rank", F.row_number().over(rarest)).where("rank = 1")
        .select("token", "rule_tokens")
    )
    return (
        tokens.select("url", "tokens", F.explode("tokens").alias("token")).join(index, "token")
        .where(F.size(F.array_except("rule_tokens", "tokens")) == 0).select("url").distinct()
    )


def url_verdicts(pages: DataFrame, labels: DataFrame, **mining: float) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, matched.

    The host reaches from the first ``://`` to the next ``/``, ``?`` or ``#``; a null url, or one
    without ``://``, has an empty host and path, fits no rule and is allowed unless mined tokens match.
    Rules of the list win over mined ones. Repeated pages are judged each. Without labels nothing is
    mined. Only page_id and url of ``pages`` are used, and doc_id, quality and toxic of ``labels``.
    """
    rules = written(mine_rules(labelled_tokens(pages, labels), **mining), cores(pages))
    hits = matched_urls(pages, rules).select(F.col("url").alias("_hit_url"))
    judged = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string")).join(
        hits, F.col("url") == F.col("_hit_url"), "left"
    )
    judged = judged.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url")), "matched": F.col("_hit_url").isNotNull()})
    judged = judged.withColumn("listed", rule_of(F.col("host"), F.col("path")))
    return judged.select(
        "page_id", "host", "path", F.col("listed.rule").alias("rule"),
        F.coalesce("listed.verdict", F.when(F.col("matched"), "block").otherwise("allow")).alias("verdict"), "matched",
    )

"""URL filter: rules first, then the ratio of two character language models.

One variable-order Markov model learns the accepted and one the rejected URLs.
A URL's log-likelihood difference per character is held against a threshold
calibrated on labelled URLs that neither model has seen. All steps are DataFrame
operations; the counts are taken over every distinct URL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barograph.llm.common import load, query, stored, upper_to_lower

#: Rules (verdict, host, path); a host fits its subdomains, a path what begins with it.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
ORDER = 5  # characters of the longest n-gram
STRENGTH = 4.0  # weight of the next shorter context, in observations
SYMBOLS = 128.0
#: N-grams with at least this share of all positions are joined by broadcast; there are at most 1 / share.
HOT_SHARE = 1 / 2000
BINS = 4001  # steps of the calibration curve over [-10, 10] bits a character


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return (upper_to_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def longest_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Rule text and verdict of the longest fitting rule, both null if none fits."""
    name = verdict = F.lit(None).cast("string")
    for decision, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, rule_host + rule_path).otherwise(name)
        verdict = F.when(fits, decision).otherwise(verdict)
    return name, verdict


def gram_events(urls: DataFrame) -> DataFrame:
    """One row for each character of a URL and its end, with the characters before it."""
    padded = F.concat(F.lit("\u0001" * (ORDER - 1)), "site", F.lit("\u0002"))
    return urls.withColumn("p", F.explode(F.sequence(F.lit(1), F.length("site") + 1))).select(
        "site", "accepted", "rejected", F.substring(padded, F.col("p"), F.lit(ORDER)).alias("gram"))


def _smoothed(grams: DataFrame, label: str, table: DataFrame) -> DataFrame:
    """Add the probability of each gram's last character under one model."""
    p = F.lit(1 / SYMBOLS)
    for k in range(1, ORDER + 1):
        tail, context = f"right(gram, {k})", f"substr(right(gram, {k}), 1, {k - 1})"
        n, m = f"{label}_n{k}", f"{label}_m{k}"
        ends = grams.groupBy(F.expr(tail).alias(f"t{k}")).agg(F.sum(label).alias(n))
        begins = grams.groupBy(F.expr(context).alias(f"c{k}")).agg(F.sum(label).alias(m))
        table = (table.withColumns({f"t{k}": F.expr(tail), f"c{k}": F.expr(context)})
                 .join(ends, f"t{k}").join(begins, f"c{k}").drop(f"t{k}", f"c{k}"))
        p = (F.col(n) + STRENGTH * p) / (F.col(m) + STRENGTH)
    return table.withColumn(f"p_{label}", p)


def gram_ratios(events: DataFrame) -> DataFrame:
    """Each n-gram with its count ``n`` and the bits by which the accepted model prefers it."""
    grams = stored(events.groupBy("gram").agg(
        F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"),
        F.count("*").alias("n")), "url-grams")
    table = grams.select("gram", "n")
    for label in ("accepted", "rejected"):
        table = _smoothed(grams, label, table)
    return stored(table.select("gram", "n", (F.log2("p_accepted") - F.log2("p_rejected")).alias("bits")),
                  "url-ratios")


def url_scores(urls: DataFrame) -> DataFrame:
    """``site, score``: log-likelihood difference in bits a character."""
    events = gram_events(urls)
    ratios = gram_ratios(events)
    total = ratios.agg(F.sum("n")).first()[0] or 0
    hot = ratios.where(F.col("n") >= total * HOT_SHARE).select("gram", "bits")
    cold = ratios.where(F.col("n") < total * HOT_SHARE).select("gram", "bits")
    tried = events.select("site", "gram").join(F.broadcast(hot), "gram", "left")
    known = tried.where("bits IS NOT NULL").select("site", "bits")
    looked_up = tried.where("bits IS NULL").select("site", "gram").join(cold, "gram").select("site", "bits")
    parts = [part.groupBy("site").agg(F.sum("bits").alias("bits"), F.count("*").alias("n"))
             for part in (known, looked_up)]
    return reduce(DataFrame.unionByName, parts).groupBy("site").agg(
        (F.sum("bits") / F.sum("n")).alias("score"))


def threshold(scored: DataFrame) -> float:
    """Score from which a URL is accepted: least errors on labelled rows, classes weighted alike.

    It lies midway to the labelled score below. Zero when one of the classes has no row.
    """
    step = F.least(F.greatest(F.floor((F.col("score") + 10) * 200), F.lit(0)), F.lit(BINS - 1))
    curve = scored.groupBy(step.alias("step")).agg(
        F.sum(F.col("allowed").cast("double")).alias("good"),
        F.sum((~F.col("allowed")).cast("double")).alias("bad"))  # at most BINS rows
    below = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    share = lambda c: F.try_divide(F.coalesce(F.sum(c).over(below), F.lit(0.0)), F.sum(c).over(whole))
    best = (curve.withColumns({"cost": share("good") - share("bad"),
                               "before": F.lag("step").over(Window.orderBy("step"))})
            .where("cost IS NOT NULL").orderBy("cost", "step").first())
    if best is None:
        return 0.0
    return (best.step if best.before is None else (best.before + 1 + best.step) / 2) / 200 - 10


def filter_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` for every row of ``pages``.

    URLs that a rule decides are the labels. The models see the whole URL; host
    and path serve the rules. A null URL, or one without ``://``, has an empty
    host and path; a null one is scored as an empty string. Repeated rows stay;
    equal URLs are scored once. URLs of any length are scored whole, other
    columns of ``pages`` are ignored, and an empty table gives no rows.
    """
    host, path = url_parts(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"), F.coalesce("url", F.lit("")).alias("site"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    rows = rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("decided"),
                       "site")
    # The label follows from the URL.
    sites = stored(rows.groupBy("site").agg(F.max("decided").alias("decided")), "url-sites")
    held = F.pmod(F.crc32(F.col("site").cast("binary")), F.lit(5)) == 0
    learn = lambda v: F.coalesce(((F.col("decided") == v) & ~held), F.lit(False)).cast("bigint")
    scores = stored(url_scores(sites.select(
        "site", learn("allow").alias("accepted"), learn("block").alias("rejected"))), "url-scores")
    labelled = scores.join(sites.where(held & F.col("decided").isNotNull()), "site").select(
        "score", (F.col("decided") == "allow").alias("allowed"))
    limit = threshold(labelled)
    return rows.join(scores, "site").select(
        "page_id", "host", "path", "rule",
        F.coalesce("decided", F.when(F.col("score") >= limit, "allow").otherwise("block")).alias("verdict"),
        "score")


@query()
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(load(spark, sf_dir, "pages"))

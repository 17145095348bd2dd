"""URL filters: rules on host and path, and link-graph propagation for what no rule decides.

Hosts of pages that a rule allows are trusted seeds, hosts of pages that a rule blocks are blocked
seeds, weighted by their pages. Trust is personalised PageRank from the trusted seeds along host
links; distrust is the same from the blocked seeds along reversed links: who links to a blocked
host is distrusted. A host whose distrust exceeds its trust by more than a threshold is blocked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import leaves_result_only, settle

DAMPING = 0.85
#: Propagation ends when no host gains more than this share of its rank.
TOLERANCE = 1e-9
SETTLE_EVERY = 4
THRESHOLD = 0.0


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty for null or without ://."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ? # or the end; empty for null or without ://."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def match_rules(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """pages(host, path, ...) with rule and rule_verdict: those of the longest rule that fits, else null.

    rules(host, path, verdict) are keyed by host: a page meets only rules of its host and the
    domains above it, so any number of rules costs one join on a key. Of equally long rules the
    first by code point wins; a rule listed twice counts once, with its smaller verdict.
    """
    hosts = pages.select("host").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    known = rules.groupBy(F.col("host").alias("rule_host"), F.col("path").alias("rule_path")).agg(F.min("verdict").alias("v"))
    by_host = hosts.select("host", F.explode(F.array_distinct(suffixes)).alias("rule_host")).join(known, "rule_host")
    text = F.concat("rule_host", "rule_path")
    # A host's rules are few: they travel as one list with it.
    listed = by_host.groupBy("host").agg(
        F.array_sort(F.collect_list(F.struct((-F.char_length(text)).alias("n"), text.alias("rule"), F.col("rule_path").alias("path"), "v"))).alias("fits")
    )
    best = F.get(F.filter("fits", lambda r: F.startswith(F.col("path"), r["path"])), 0)
    # Settled, so that pages are dealt anew and adaptive execution can split a hot host.
    out = pages.join(settle(listed), "host", "left").withColumn("best", best)
    return out.withColumns({"rule": F.col("best.rule"), "rule_verdict": F.col("best.v")}).drop("fits", "best")


def host_links(pages: DataFrame) -> DataFrame:
    """(src, dst, n) between different hosts, from the href of every page(host, html). Relative links stay on their host."""
    href = F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(r"(?i)\shref\s*=\s*[\"']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^\"'\s>]+)"), F.lit(1))
    links = pages.select(F.col("host").alias("src"), F.explode(href).alias("url"))
    absolute = F.when(F.startswith("url", F.lit("//")), F.concat(F.lit("http:"), "url")).otherwise(F.col("url"))
    links = links.select("src", host_of(absolute).alias("dst"))
    return links.where("src <> dst and src <> '' and dst <> ''").groupBy("src", "dst").agg(F.count("*").alias("n"))


def propagate(links: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int | None = None) -> DataFrame:
    """(host, rank): personalised PageRank over links(src, dst, n) from seeds(host, weight); ranks of all sum to 1.

    Every round keeps damping of the rank on the links and sends the rest, and what hosts without
    links hold, back to the seeds. Hosts that nothing reaches are absent. No seeds: an empty table.
    Without a number of rounds, ranks are those that more rounds would not change, at any distance.
    """
    total = seeds.agg(F.sum("weight")).first()[0]
    if not total:
        return seeds.select("host", F.lit(0.0).alias("rank"))
    seeds = seeds.select("host", (F.col("weight") / F.lit(float(total))).alias("seed"))
    if links.isEmpty():
        return seeds.withColumnRenamed("seed", "rank")
    out = links.groupBy("src").agg(F.sum("n").alias("all"))
    flow = settle(links.join(out, "src").select("src", "dst", (F.col("n") / F.col("all")).alias("part")))
    seeds = settle(seeds)
    ranks = seeds.withColumnRenamed("seed", "rank")
    if rounds is None:
        return _settled_ranks(flow, ranks, damping)
    for i in range(1, rounds + 1):
        moved = flow.join(ranks, flow["src"] == ranks["host"]).groupBy(F.col("dst").alias("host"))
        moved = settle(moved.agg((damping * F.sum(F.col("part") * F.col("rank"))).alias("rank")))
        kept = moved.agg(F.sum("rank")).first()[0] or 0.0
        ranks = moved.unionByName(seeds.select("host", (F.col("seed") * F.lit(1 - kept)).alias("rank")))
        ranks = ranks.groupBy("host").agg(F.sum("rank").alias("rank"))
        if i % SETTLE_EVERY == 0:
            ranks = settle(ranks)
    return ranks


def _settled_ranks(flow: DataFrame, seeds: DataFrame, damping: float) -> DataFrame:
    """The ranks that rounds tend to: what seeds send over paths of any length, scaled to sum to 1.

    A host reached for the first time gains all of its rank, so rounds go on while any is new.
    """
    ranks, step = seeds, seeds
    while True:
        moved = flow.join(step, flow["src"] == step["host"]).groupBy(F.col("dst").alias("host"))
        step = settle(moved.agg((damping * F.sum(F.col("part") * F.col("rank"))).alias("rank")))
        both = ranks.withColumn("gain", F.lit(0.0)).unionByName(step.withColumn("gain", F.col("rank")))
        both = settle(both.groupBy("host").agg(F.sum("rank").alias("rank"), F.sum("gain").alias("gain")))
        ranks = both.select("host", "rank")
        if both.where(F.col("gain") > TOLERANCE * F.col("rank")).isEmpty():
            break
    total = ranks.agg(F.sum("rank")).first()[0]
    return ranks.select("host", (F.col("rank") / F.lit(total)).alias("rank"))


def _significant(x: Column) -> Column:
    """x to 12 significant digits, 0 for null: sums of any order agree, and no rank is too small to count."""
    return F.when(x.isNull(), 0.0).otherwise(F.format_string("%.11e", x).cast("double"))


@leaves_result_only
def judge(pages: DataFrame, rules: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust), one row for each row of pages(page_id, url, html, ...).

    verdict is the rule's where one fits; else block if the host's distrust exceeds its trust by
    more than threshold, otherwise allow (so a host that nothing reaches is allowed). Null urls and
    urls without :// have an empty host and path, which no rule or link reaches. Null pages have no
    links. Repeated rows are judged alike; other columns are ignored; an empty table gives an empty table.
    """
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    rows = rows.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    links = settle(host_links(rows))
    ruled = settle(match_rules(rows.select("page_id", "host", "path"), rules))
    seeds = ruled.where("rule is not null").groupBy("host", "rule_verdict").agg(F.count("*").alias("weight"))
    trust = propagate(links, seeds.where("rule_verdict = 'allow'").select("host", "weight"))
    reverse = links.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    distrust = propagate(reverse, seeds.where("rule_verdict = 'block'").select("host", "weight"))
    scores = trust.withColumnRenamed("rank", "trust").join(distrust.withColumnRenamed("rank", "distrust"), "host", "full")
    scores = settle(scores.select("host", *[_significant(F.col(c)).alias(c) for c in ("trust", "distrust")]))
    out = ruled.join(scores, "host", "left").na.fill(0.0, ["trust", "distrust"])
    own = F.when(F.col("distrust") - F.col("trust") > threshold, "block").otherwise("allow")
    return out.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", own).alias("verdict"), "trust", "distrust")

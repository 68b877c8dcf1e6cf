"""URL filters: listed rules, and association rules that FP-growth mines from labelled urls.

A url's tokens are its host's labels, its path's segments and its query's keys. Labelled urls are transactions of their
tokens and their label; rules with the label "bad" as consequent stay when support and confidence reach the limits and no
part of their antecedent is as sure. A rule is filed in an inverted index under its rarest token, and pages meet only the
rules filed under one of their own tokens.

Before the mining, tokens go that can be in no such rule but alone: those below the support among bad urls, and those that are bad
always, whose rule is filed at once as no wider one is surer. Tokens that occur in the very same urls are one. All that is
left is mined, however many tokens a url has: FP-growth deals each token's conditional base, the distinct sets of more frequent
tokens beside it, to a task, and grows sets from it. A set isn't grown where no wider one can stay: below the support, when all its
urls are bad, or when a token is in all urls of the rest, as the rest alone is as sure then. The time still grows with the number of
sets that are left. Frequent tokens are at most (tokens of a url / support) many, and rules at most MOST_RULES before the index is
broadcast; more rules are matched by a join on their token.

Labels are of documents and are joined to pages by equal number, as both tables count the same crawl: page n is the source of document n.

Defined cases: a null url, or one without "://", has an empty host and path, no rule and verdict allow; labels that are
missing or null don't count; without labels no rule is mined; repeated rows are judged one by one; further columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: (host, path, verdict)
RULES = (("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block"))
MOST_RULES = 100_000
_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.locate("://", url) > 0, F.substr(url, F.locate("://", url) + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return F.coalesce(F.translate(host, _UP, _LOW), F.lit("")), F.coalesce(path, F.lit(""))


def listed(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest listed rule that fits; null where none does."""
    rule = verdict = None
    for h, p, v in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, h + p) if rule is None else rule.when(fits, h + p)
        verdict = F.when(fits, v) if verdict is None else verdict.when(fits, v)
    return rule, verdict


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens: h: host labels, p: path segments (numbers as #), q: query keys."""
    parts = lambda s, by, kind: F.transform(F.filter(F.split(s, by), lambda x: x != ""), lambda x: F.concat(F.lit(kind), x))
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1)
    keys = F.transform(F.filter(F.split(query, "&"), lambda x: x != ""), lambda x: F.concat(F.lit("q:"), F.substring_index(x, "=", 1)))
    return F.array_distinct(F.concat(parts(host, r"\.", "h:"), parts(F.regexp_replace(path, r"\d+", "#"), "/", "p:"), keys))


def sure_sets(own: tuple, base: list[tuple[tuple, int, int]], least: int, confident: float, best: float = 0.0) -> Iterator[tuple[tuple, int, int]]:
    """(tokens, urls, bad urls) of the sets that hold own and tokens of its base (tokens, urls, bad urls), with `least` bad urls and the
    confidence, and surer than every set they were grown from."""
    n, bad = sum(r[1] for r in base), sum(r[2] for r in base)
    if bad < least:
        return
    if bad / n >= confident and bad / n > best:
        yield own, n, bad
    if bad == n:
        return
    best = max(best, bad / n)
    sums: dict[str, list[int]] = {}
    for tokens, m, b in base:
        for token in tokens:
            s = sums.setdefault(token, [0, 0])
            s[0] += m
            s[1] += b
    free = {token for token, (m, b) in sums.items() if b >= least and m < n}
    conditional: dict[str, dict[tuple, list[int]]] = {}
    for tokens, m, b in base:
        kept = tuple(token for token in tokens if token in free)
        for i, token in enumerate(kept):
            s = conditional.setdefault(token, {}).setdefault(kept[:i], [0, 0])
            s[0] += m
            s[1] += b
    for token, rows in conditional.items():
        yield from sure_sets((*own, token), [(tokens, m, b) for tokens, (m, b) in rows.items()], least, confident, best)


def mined_rules(transactions: DataFrame, *, least_support: float = 0.0005, least_rows: int = 5, least_confidence: float = 0.6, least_lift: float = 1.2) -> DataFrame | None:
    """(rule_id, tokens, key, confidence, support) from transactions (items, bad); None where nothing can be mined."""
    counts = transactions.agg(F.count("*").alias("n"), F.sum(F.col("bad").cast("int")).alias("bad")).first()
    if not counts.n or not counts.bad:
        return None
    n, support = counts.n, min(1.0, max(least_support, least_rows / counts.n))
    least = max(1, math.ceil(support * n - 1e-9))
    rows = stored(transactions.select("items", "bad", F.monotonically_increasing_id().alias("row")), "transactions")
    tokens = rows.select("row", "bad", F.explode("items").alias("token")).groupBy("token").agg(
        F.count("*").alias("freq"), F.sum(F.col("bad").cast("long")).alias("bad"), F.bit_xor(F.xxhash64("row")).alias("x1"), F.bit_xor(F.xxhash64("row", F.lit(1))).alias("x2"))
    sure = tokens.where(F.col("bad") >= least).withColumn("confidence", F.col("bad") / F.col("freq"))
    sure = stored(sure.groupBy("freq", "bad", "x1", "x2", "confidence").agg(F.min("token").alias("token")), "tokens")
    pure = sure.where((F.col("bad") == F.col("freq")) & (F.lit(n / counts.bad) >= least_lift)).select(F.array("token").alias("tokens"), F.lit(1.0).alias("confidence"), (F.col("bad") / n).alias("support"))
    mixed = sure.where(F.col("bad") < F.col("freq")).select("token", "freq")
    left = rows.select("row", "bad", F.explode("items").alias("token")).join(F.broadcast(mixed) if mixed.count() <= MOST_RULES else mixed, "token").groupBy("row", "bad").agg(F.array_sort(F.collect_list(F.struct((-F.col("freq")).alias("f"), "token"))).alias("some"))
    baskets = left.groupBy(F.transform("some", lambda x: x["token"]).alias("some")).agg(F.count("*").alias("n"), F.sum(F.col("bad").cast("long")).alias("bad"))
    ends = baskets.select("n", "bad", "some", F.posexplode("some").alias("at", "item")).groupBy("item", F.slice("some", 1, F.col("at")).alias("before")).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    share = counts.bad / n
    confident = max(least_confidence, least_lift * share) * (1 - 1e-12)

    def grow(t: pd.DataFrame) -> pd.DataFrame:
        base = list(zip(map(tuple, t["before"]), t["n"].tolist(), t["bad"].tolist()))
        found = [(list(x), b / m, b / n) for x, m, b in sure_sets((t["item"].iloc[0],), base, least, confident) if b / m >= least_confidence and b / m / share >= least_lift]
        return pd.DataFrame(found, columns=["tokens", "confidence", "support"])

    rules = ends.groupBy("item").applyInPandas(grow, "tokens array<string>, confidence double, support double").withColumn("tokens", F.array_sort("tokens"))
    plain = lambda t: F.replace(F.replace(t, F.lit("%"), F.lit("%25")), F.lit(" "), F.lit("%20"))
    filed = stored(rules.unionByName(pure).withColumn("rule_id", F.array_join(F.transform("tokens", plain), " ")), "rules")
    rare = filed.select("rule_id", F.explode("tokens").alias("token")).join(sure.select("token", "freq"), "token").groupBy("rule_id").agg(F.min_by("token", F.struct("freq", "token")).alias("key"))
    filed = filed.join(rare, "rule_id")
    parts = filed.select("rule_id", F.explode("tokens").alias("token"), "tokens", "confidence")
    wider = filed.select(F.col("key").alias("token"), F.col("tokens").alias("t2"), F.col("confidence").alias("c2"))
    idle = parts.join(wider, "token").where((F.size("t2") < F.size("tokens")) & (F.col("c2") >= F.col("confidence")) & (F.size(F.array_except("t2", "tokens")) == 0)).select("rule_id").distinct()
    return stored(filed.join(idle, "rule_id", "left_anti").select("rule_id", "tokens", "key", "confidence", "support"), "index")


def judged_urls(pages: DataFrame, labels: DataFrame, *, id_col: str = "page_id", url_col: str = "url", label_id: str = "doc_id", label_col: str = "quality", rules=RULES, **limits) -> DataFrame:
    """(page_id, host, path, rule, verdict, mined_rule, confidence); a label of 0 is bad, any other value is not."""
    host, path = host_and_path(F.col(url_col).cast("string"))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("items", url_tokens(F.col("url"), F.col("host"), F.col("path")))
    known = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(label_id).alias("label_id")).agg((F.min(label_col) == 0).alias("bad"))
    transactions = rows.where(F.size("items") > 0).join(known, rows["page_id"] == known["label_id"]).select("items", "bad")
    rule, verdict = listed(F.col("host"), F.col("path"), rules)
    out = rows.withColumns({"rule": rule, "listed": verdict})
    mined = mined_rules(transactions, **limits)
    if mined is None:
        return out.select("page_id", "host", "path", "rule", F.coalesce("listed", F.lit("allow")).alias("verdict"), F.lit(None).cast("string").alias("mined_rule"), F.lit(None).cast("double").alias("confidence"))
    # equal urls are matched once
    urls = out.select("url", "items").where("url is not null").distinct()
    mined = F.broadcast(mined) if mined.count() <= MOST_RULES else mined
    near = urls.select("url", "items", F.explode("items").alias("key")).join(mined, "key").where(F.size(F.array_except("tokens", "items")) == 0)
    best = near.groupBy("url").agg(F.max(F.struct("confidence", "support", "rule_id")).alias("best"))
    return out.join(best, "url", "left").select("page_id", "host", "path", "rule", F.coalesce("listed", F.when(F.col("best").isNotNull(), "block"), F.lit("allow")).alias("verdict"), F.col("best.rule_id").alias("mined_rule"), F.col("best.confidence").alias("confidence"))

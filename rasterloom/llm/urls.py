"""URL verdicts: given host rules first, then association rules mined from labelled pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from rasterloom.llm.tables import stored

#: Given rules, as (verdict, host, path). Fixed values.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

BAD = "label=bad"
#: A mined rule holds on at least so many labelled bad pages, and so large a share of its pages is bad.
MIN_PAGES, MIN_CONFIDENCE = 20, 0.8


def parsed(url):
    """Host (A-Z lower-cased) and path of a url column; both empty without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    part = lambda i: F.coalesce(F.regexp_extract(url, pattern, i), F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(part(1), upper, upper.lower()), part(2)


def given_rule(host, path, rules=RULES):
    """The longest of the given rules that fits, as struct(rule, verdict), or null."""
    choice = F
    for verdict, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        choice = choice.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict")))
    return choice.otherwise(F.lit(None))


def tokens(url, host, path):
    """All distinct tokens of a url; their number follows its length.

    Scheme; the last one to three host labels, the first label, and every label, by its place from the
    end and at any place; every path segment by its place (digits as #) and its words as they are; the
    extension; every query key, every key with its value and the words of the values; whether there is
    a fragment, and which. Words are runs of letters and digits.
    """
    text = lambda name, value: F.when(F.length(value) > 0, F.concat(F.lit(name + "="), value))
    named = lambda name, values: F.transform(values, lambda x: text(name, x))
    placed = lambda name, values: F.transform(values, lambda x, i: F.when(F.length(x) > 0, F.concat(F.lit(name), (i + 1).cast("string"), F.lit("="), x)))
    words = lambda value: F.regexp_extract_all(value, F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    labels = F.split(host, r"\.")
    segments = F.split(F.regexp_replace(F.regexp_replace(path, "^/", ""), "[0-9]+", "#"), "/")
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    keys = F.regexp_extract_all(query, F.lit(r"(?:^|&)([^=&]+)"), F.lit(1))
    values = F.regexp_replace(query, "(^|&)[^=&]*", "&")
    found = F.concat(
        F.array(
            text("scheme", F.regexp_extract(url, r"(?s)^(.*?)://", 1)), text("last1", F.substring_index(host, ".", -1)),
            text("last2", F.substring_index(host, ".", -2)), text("last3", F.substring_index(host, ".", -3)), text("first", F.substring_index(host, ".", 1)),
            text("ext", F.regexp_extract(path, r"\.([A-Za-z0-9]{1,8})$", 1)),
            F.when(F.contains(url, F.lit("#")), F.lit("fragment")), text("fragment", F.regexp_extract(url, r"(?s)^[^#]*#(.*)$", 1))),
        placed("label", F.reverse(labels)), named("label", labels), placed("path", segments), named("word", words(path)),
        named("key", keys), named("query", F.split(query, "&")), named("value", words(values)))
    return F.coalesce(F.array_distinct(F.array_compact(found)), F.array().cast("array<string>"))


def _grown(held):
    """Each token set with each token behind it in its basket."""
    longer = F.transform("rest", lambda t, i: F.struct(F.concat("items", F.array(t)).alias("items"), F.slice("rest", i + 2, F.size("rest")).alias("rest")))
    return held.select("n", "bad", F.inline(longer))


def mine(pages, min_pages=MIN_PAGES, min_confidence=MIN_CONFIDENCE):
    """Rules from labelled pages: token sets of any length that mark bad pages.

    ``pages``: tokens, bad (boolean). Sets grow by one token a round. A set goes no further if it is on
    fewer than ``min_pages`` bad pages, if it is a rule (what holds a rule's tokens is bad already), or if
    a token less gives the same pages (then the smaller set is as good a rule and fits more urls).
    What holds such a set is as useless, so no verdict is lost. Pages count as one once tokens on too few
    bad pages are gone and the rest is equal. Returns items (sorted array), support, confidence.
    """
    rows = stored(pages.select(F.monotonically_increasing_id().alias("uid"), F.col("bad").cast("bigint").alias("bad"), F.array_distinct("tokens").alias("tokens")), "labelled")
    share = F.col("support") / F.col("freq")
    rule = share >= min_confidence
    singles = rows.select("bad", F.explode("tokens").alias("token"))
    found = singles.groupBy("token").agg(F.sum("bad").alias("support"), F.count(F.lit(1)).alias("freq")).filter(F.col("support") >= min_pages)
    found = stored(found.select(F.array("token").alias("items"), "support", "freq"), "itemsets")
    rules, kept = found.filter(rule), found.filter(~rule)
    if not kept.isEmpty():
        common = kept.select(F.get("items", F.lit(0)).alias("token"))
        baskets = rows.select("uid", "bad", F.explode("tokens").alias("token")).join(common, "token").groupBy("uid").agg(
            F.first("bad").alias("bad"), F.array_sort(F.collect_list("token")).alias("rest"))
        baskets = baskets.groupBy("rest").agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("bad"))
        held = stored(_grown(baskets.withColumn("items", F.array().cast("array<string>"))), "held")
    while not kept.isEmpty():
        longer = _grown(held)
        found = longer.groupBy("items").agg(F.sum("bad").alias("support"), F.sum("n").alias("freq")).filter(F.col("support") >= min_pages)
        parts = found.select("*", F.explode(F.transform("items", lambda t: F.array_remove("items", t))).alias("part"))
        parts = parts.join(kept.select(F.col("items").alias("part"), F.col("freq").alias("wider")), "part")
        found = parts.groupBy("items", "support", "freq").agg(F.count(F.lit(1)).alias("parts"), F.min("wider").alias("wider"))
        found = found.filter((F.col("parts") == F.size("items")) & (F.col("wider") > F.col("freq")))
        found = stored(found.select("items", "support", "freq"), "itemsets")
        rules, kept = rules.unionByName(found.filter(rule)), found.filter(~rule)
        if not kept.isEmpty():
            held = stored(longer.join(kept.select("items"), "items", "left_semi"), "held")
    return rules.select("items", "support", share.alias("confidence"))


def verdicts(pages, labels, min_pages=MIN_PAGES, min_confidence=MIN_CONFIDENCE):
    """Host, path, given rule and verdict of each page.

    ``pages``: page_id, url; ``labels``: doc_id (of the page), quality, toxic; other columns are ignored.
    A page is bad if its label says low quality or toxic. Given rules decide first; else a page is
    blocked if it holds all tokens of a mined rule, and allowed otherwise. Null urls and urls without
    ``://`` have empty host and path and no tokens; repeated rows are judged alike; without labels there
    are no mined rules.

    Mined rules are indexed by their rarest token. A page looks up all its tokens, and a rule found is
    tested against all of them.

    Returns page_id, host, path, rule, verdict, mined (the mined rule's tokens, or null).
    """
    host, path = parsed(F.col("url"))
    rows = pages.select(F.monotonically_increasing_id().alias("uid"), "page_id", "url", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("tokens", F.when((F.col("host") == "") & (F.col("path") == ""), F.array().cast("array<string>")).otherwise(
        tokens(F.col("url"), F.col("host"), F.col("path")))).drop("url")
    rows = stored(rows, "urls")
    marks = labels.select(F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad")).dropna()
    rules = stored(mine(rows.join(marks, "page_id").select("tokens", "bad"), min_pages, min_confidence), "kept-rules")
    common = rules.select(F.explode("items").alias("token")).distinct()
    uses = rows.select(F.explode("tokens").alias("token")).join(common, "token").groupBy("token").count()
    index = rules.select("items", F.explode("items").alias("token")).join(uses, "token")
    index = index.groupBy("items").agg(F.min_by("token", F.struct("count", "token")).alias("token"))
    seen = rows.select("uid", F.explode("tokens").alias("token")).join(index, "token").select("uid", "items")
    hits = seen.join(rows.select("uid", "tokens"), "uid").filter(F.size(F.array_except("items", "tokens")) == 0).groupBy("uid").agg(F.min("items").alias("mined"))
    own = given_rule(F.col("host"), F.col("path"))
    return rows.join(hits, "uid", "left").withColumn("own", own).select(
        "page_id", "host", "path", F.col("own.rule").alias("rule"),
        F.coalesce(F.col("own.verdict"), F.when(F.col("mined").isNotNull(), "block").otherwise("allow")).alias("verdict"), "mined")

"""URL filters: explicit host and path rules, and association rules mined from labels.

A URL's host and path come from built-in string functions. An explicit rule fits its host and all subdomains when the
path starts with the rule's path; the longest fitting rule decides. All other URLs are judged by rules that Spark's
FP-growth mines from labelled URLs: items are the URL's tokens (host labels, words of the path, parameter names) and
the label; rules "tokens -> bad" are kept above a support, a confidence and a lift, and rules that a shorter
one already covers are pruned. Tokens that stand in exactly the same labelled URLs (a site's parameter names) are mined
as one, so a template of many names does not multiply the item sets; a rule then takes any of them. Rules are
matched through an inverted index: each rule stands under its rarest token and that one's equals, URLs look up their
tokens and check the rest of the rule.

A URL is labelled by the document that its last number names: bad if that document's quality is 0 or it is toxic. Hot
hosts are no keys here: rows meet rules by token, and the rules' side is small. Defined cases: null URLs and URLs without
``://`` have empty host and path and the verdict allow; without labels no rule is mined and all others are
allowed; repeated rows are judged alike; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlab.llm.common import staged

SUPPORT = 0.002         # share of labelled URLs that a rule's tokens and label must hold
LEAST_ROWS = 5          # and their number
CONFIDENCE = 0.6
LIFT = 1.5
BAD = "label=bad"

# The explicit rules of this site list, (action, host/path prefix).
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))


def with_parts(pages: DataFrame) -> DataFrame:
    """Add host and path."""
    url = F.coalesce(F.col("url"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), "^[^?#]*", 0)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return pages.withColumn("host", F.translate(raw, upper, upper.lower())).withColumn("path", path)


def explicit_rule(rules=RULES):
    """struct(rule, action) of the longest rule that fits host and path, or null."""
    found = F.lit(None).cast("struct<rule:string,action:string>")
    for action, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        host, slash, path = rule.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(slash + path)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(action).alias("action"))).otherwise(found)
    return found


def tokens():
    """Different tokens of a URL with host and path: host labels, words of the path, parameter names, scheme."""
    query = F.regexp_extract(F.col("url"), "[?]([^#]*)", 1)
    words = lambda c, p, mark: F.transform(F.regexp_extract_all(c, F.lit(p), 0), lambda x: F.concat(F.lit(mark), F.lower(x)))
    return F.array_distinct(F.concat(words(F.col("host"), "[^.\\-:@]+", "h:"), words(F.col("path"), "\\p{L}[\\p{L}\\p{N}]*", "p:"),
                                     words(query, "[^&=]+(?==)", "q:")))


def labelled_urls(parts: DataFrame, labels: DataFrame) -> DataFrame:
    """(items): the tokens of every URL whose last number names a labelled document, and its label."""
    bad = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).when(F.col("quality").isNotNull() | F.col("toxic").isNotNull(), 0)).alias("bad")).where("bad is not null")
    number = F.regexp_extract("path", "([0-9]{1,18})[^0-9]*$", 1)
    rows = parts.where(F.col("host") != "").select(tokens().alias("items"), F.when(number != "", number.cast("long")).alias("doc_id")).join(bad, "doc_id")
    return rows.select(F.when(F.col("bad") == 1, F.array_append("items", F.lit(BAD))).otherwise(F.col("items")).alias("items")).where(F.size("items") > 0)


RULE = "tokens array<string>, confidence double, support double, lift double, choices array<array<string>>"


def token_classes(items: DataFrame, total: int, support: float) -> list[list[str]]:
    """The tokens that can be in a rule, those with equal sets of rows together; the label stands alone.

    Only tokens with enough bad rows matter (at most tokens per URL / SUPPORT of them); those in nearly all URLs tell
    nothing. Row sets are compared by their size and two sums of 64-bit row hashes."""
    row = items.select(F.monotonically_increasing_id().alias("i"), F.array_contains("items", BAD).cast("int").alias("bad"), "items")
    count = row.select("i", "bad", F.explode(F.array_distinct("items")).alias("t")).groupBy("t").agg(
        F.count("*").alias("n"), F.sum("bad").alias("bad"), F.bit_xor(F.xxhash64("i")).alias("x"),
        F.sum(F.xxhash64("i", F.lit("second")).cast("decimal(20,0)")).alias("y"))
    used = count.where((F.col("bad") >= support * total) & ((F.col("n") < 0.95 * total) | (F.col("t") == BAD))).collect()
    classes = {}
    for r in sorted(used, key=lambda r: r.t):
        classes.setdefault((r.t == BAD, r.n, r.x, r.y), []).append(r.t)
    return list(classes.values())


def mine(items: DataFrame) -> DataFrame:
    """(tokens, confidence, support, lift, choices): pruned rules tokens -> bad; in a rule of several tokens, the ``choices`` of
    a token are the tokens with the same labelled URLs, any of which will do (the token is the first of them)."""
    from pyspark.ml.fpm import FPGrowth
    items = staged(items, "url-items")
    spark, total = items.sparkSession, items.count()
    if not total:
        return spark.createDataFrame([], RULE)
    support = min(1.0, max(SUPPORT, LEAST_ROWS / total))
    classes = token_classes(items, total, support)
    baskets = items.select(F.array_intersect("items", F.array(*[F.lit(c[0]) for c in classes]).cast("array<string>")).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=CONFIDENCE).fit(baskets)
    rules = model.associationRules.where(F.array_contains("consequent", BAD) & (F.col("lift") >= LIFT)) \
        .select(F.array_sort("antecedent").alias("tokens"), "confidence", "support", "lift")
    rules = staged(rules, "url-rules")
    # a rule is pruned where a part of it is a rule of at least its confidence
    each = rules.select("tokens", "confidence", F.explode("tokens").alias("t"))
    shorter = rules.select(F.col("tokens").alias("part"), F.col("confidence").alias("c"), F.col("tokens")[0].alias("t"))
    covered = (each.join(shorter, "t").where((F.size("part") < F.size("tokens")) & (F.col("c") >= F.col("confidence"))
                                             & (F.size(F.array_except("part", "tokens")) == 0)).select("tokens").distinct())
    rules = rules.join(covered, "tokens", "left_anti")
    equal = spark.createDataFrame([(c[0], c) for c in classes], "t string, choices array<string>")
    choices = (rules.select("tokens", F.explode("tokens").alias("t")).join(equal, "t")
               .groupBy("tokens").agg(F.array_sort(F.collect_list("choices")).alias("choices")))
    rules = rules.join(choices, "tokens").select("tokens", "confidence", "support", "lift", "choices")
    # a rule of one token is written out, a rule for each of its equals
    alone = rules.where(F.size("tokens") == 1).withColumn("t", F.explode(F.col("choices")[0])).select(
        F.array("t").alias("tokens"), "confidence", "support", "lift", F.array(F.array("t")).alias("choices"))
    return rules.where(F.size("tokens") > 1).union(alone)


def blocked_urls(parts: DataFrame, rules: DataFrame) -> DataFrame:
    """(url): the URLs that some mined rule matches."""
    urls = parts.where(F.col("host") != "").select("url", tokens().alias("items"))
    count = urls.select(F.explode("items").alias("t")).groupBy("t").count()
    each = rules.select("tokens", "choices", F.posexplode("choices").alias("place", "same")).select("*", F.explode("same").alias("t")).join(count, "t", "left")
    size = each.groupBy("tokens", "place").agg(F.sum(F.coalesce("count", F.lit(0))).alias("size"))
    rarest = size.groupBy("tokens").agg(F.min(F.struct("size", "place")).alias("m")).select("tokens", F.col("m.place").alias("place"))
    index = each.join(rarest, ["tokens", "place"]).select("t", "choices")
    index = staged(index, "url-rule-index")
    if index.isEmpty():
        return parts.select("url").limit(0)
    return (urls.select("url", "items", F.explode("items").alias("t")).join(index, "t")
            .where(F.forall("choices", lambda c: F.arrays_overlap(c, F.col("items")))).select("url").distinct())


def verdicts(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict of every page."""
    parts = with_parts(pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url")))
    rules = mine(labelled_urls(parts, labels))
    blocked = staged(blocked_urls(parts, rules), "blocked-urls").withColumn("hit", F.lit(True))
    fit = F.col("fit")
    return (parts.join(blocked, "url", "left").withColumn("fit", explicit_rule())
            .select("page_id", "host", "path", fit["rule"].alias("rule"),
                    F.coalesce(fit["action"], F.when(F.col("hit"), "block").otherwise("allow")).alias("verdict")))

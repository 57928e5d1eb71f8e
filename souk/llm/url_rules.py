"""URL filters: fixed prefix rules, and token-combination rules mined by FP-growth from labelled urls.

A url becomes the set of its tokens (scheme, host labels, path segments, file
ending, query names; numbers become one token).  FP-growth over the urls that
have the label gives the frequent combinations of up to MAX_TOKENS tokens; their
exact counts over all labelled urls give confidence and support.  Rules below
MIN_SUPPORT, MIN_COUNT or MIN_CONFIDENCE are pruned, and so is a rule when a more
general one (any part of its tokens) is at least as confident.  What is left is an
inverted index: every rule is posted under its rarest token.  Distinct token
sets (not urls) look up their tokens, keep the postings whose whole combination
they contain, and take the most confident rule.

Defined results: a null url, or one without ``://``, has an empty host and
path and no tokens, so no rule fits and it is allowed; labels that are null are
not learned from; without labelled rows nothing is mined and all verdicts but
those of the fixed rules are allow; a url may have any number of tokens: only those
frequent among the urls with the label are combined, at most MAX_TOKENS at a time, from
chunks of bounded size; repeated rows get equal results; ties between
mined rules go to the one that is first by code point.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.llm.common import UPPER, partitions, small
from souk.session import reliable_checkpoint

# The rules of the contract as host/path and verdict.
RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)
#: Share of the labelled urls that a mined rule covers at least, and of those the share with the label.
MIN_SUPPORT = 0.002
MIN_CONFIDENCE = 0.6
#: Urls with the label that a mined rule rests on at least: two or three may agree by chance.
MIN_COUNT = 5
#: Tokens of a rule at most, and of a block of the chunks that FP-growth is given.
MAX_TOKENS = 3
BLOCK = 2


def host(url: Column) -> Column:
    at = F.instr(url, "://")
    found = F.regexp_extract(F.substring(url, at + 3, F.length(url)), r"^[^/?#]*", 0)
    return F.when(at > 0, F.translate(found, UPPER, UPPER.lower())).otherwise("")


def path(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.regexp_extract(F.substring(url, at + 3, F.length(url)), r"^[^/?#]*([^?#]*)", 1)).otherwise("")


def fixed_rule(h: Column, p: Column, rules: tuple[tuple[str, str], ...] = RULES) -> Column:
    """The longest rule that fits host and path, as struct(rule, verdict); null if none does."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: len(r[0])):  # the longest is asked first
        name, slash, rest = rule.partition("/")
        fits = ((h == name) | h.endswith(f".{name}")) & p.startswith(slash + rest)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def tokens(url: Column) -> Column:
    """The sorted distinct tokens of a url; none for a url without host."""
    h, p = host(url), path(url)
    scheme = F.lower(F.substring_index(url, "://", 1))
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    segments = F.transform(F.split(p, "/"), lambda s: F.when(s.rlike(r"^[0-9]+(\.[a-z0-9]+)?$"), F.lit("#")).otherwise(F.lower(s)))
    ending = F.regexp_extract(p, r"\.([A-Za-z0-9]{1,8})$", 1)
    named = F.transform(F.split(query, "&"), lambda s: F.substring_index(s, "=", 1))
    fragment = F.when(F.instr(url, "#") > 0, F.array(F.lit("f:#"))).otherwise(F.array().cast("array<string>"))
    parts = [
        F.array(F.concat(F.lit("s:"), scheme)),
        F.transform(F.split(h, r"\."), lambda s: F.concat(F.lit("h:"), s)),
        F.transform(segments, lambda s: F.concat(F.lit("p:"), s)),
        F.array(F.concat(F.lit("x:"), F.lower(ending))),
        F.transform(named, lambda s: F.concat(F.lit("q:"), s)),
        fragment,
    ]
    all_tokens = F.filter(F.concat(*parts), lambda t: F.length(t) > 2)
    return F.when(h != "", F.array_sort(F.array_distinct(all_tokens))).otherwise(F.array().cast("array<string>"))


def _chunks(sets: DataFrame) -> DataFrame:
    """items: small sets that together hold every combination of up to MAX_TOKENS tokens of each of the given sets.

    The tokens of a set are cut into blocks of BLOCK; every choice of MAX_TOKENS blocks is a chunk (all of a set that
    has no more blocks than that).  FP-growth below a chunk cannot go beyond 2 ** (BLOCK * MAX_TOKENS) combinations.
    """
    d = sets.select("items", F.ceil(F.size("items") / BLOCK).cast("int").alias("n"))
    narrow = d.where(F.col("n") <= MAX_TOKENS).select("items")
    wide = d.where(F.col("n") > MAX_TOKENS).withColumns({"at": F.lit(-1), "chunk": F.array().cast("array<string>")})
    for left in range(MAX_TOKENS - 1, -1, -1):  # left: blocks still to choose after this one
        wide = wide.withColumn("at", F.explode(F.sequence(F.col("at") + 1, F.col("n") - 1 - left)))
        wide = wide.withColumn("chunk", F.concat("chunk", F.slice("items", F.col("at") * BLOCK + 1, F.lit(BLOCK))))
    return narrow.unionByName(wide.select(F.col("chunk").alias("items")))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, min_count: int = MIN_COUNT) -> DataFrame:
    """Rules (rule, tokens, rarest, confidence, support) of up to MAX_TOKENS tokens from labelled (url, bad); all labelled rows are used."""
    spark = labelled.sparkSession
    rows = labelled.where(F.col("bad").isNotNull()).select(tokens(F.col("url")).alias("items"), F.col("bad").cast("long").alias("bad")).where(F.size("items") > 0)
    baskets = reliable_checkpoint(rows.groupBy("items").agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("bad")))
    total = baskets.agg(F.sum("n")).first()[0] or 0  # one number
    least = max(min_count, math.ceil(min_support * total))
    single = baskets.select(F.explode("items").alias("t"), "n", "bad").groupBy("t").agg(F.sum("n").alias("freq"), F.sum("bad").alias("hits"))
    single = reliable_checkpoint(single.where(F.col("hits") >= least))  # a combination is no more frequent than its tokens
    # a token that always has the label is a rule, and no combination with it can be more confident
    sure = single.where(F.col("hits") == F.col("freq")).select(F.array("t").alias("tokens"), "freq", "hits")
    open_ = small(single.where(F.col("hits") < F.col("freq")).select("t"))
    numbered = baskets.withColumn("k", F.xxhash64("items")).withColumn("k2", F.xxhash64(F.lit("set"), "items"))
    kept = numbered.select("k", "k2", "n", "bad", F.explode("items").alias("t")).join(open_, "t")
    kept = kept.groupBy("k", "k2").agg(F.first("n").alias("n"), F.first("bad").alias("bad"), F.array_sort(F.collect_list("t")).alias("items"))
    kept = reliable_checkpoint(kept.groupBy("items").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")))
    # FP-growth over the urls with the label; a combination within a few blocks is in several chunks, so the counts it
    # gives are at least the true ones: what it finds is counted once more below
    urls = kept.where(F.col("bad") > 0).withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), "bad"))).select("items")
    chunks = reliable_checkpoint(_chunks(urls))
    number = chunks.count()
    found = spark.createDataFrame([], "tokens array<string>")
    if number:
        model = FPGrowth(itemsCol="items", minSupport=max(0.0, least - 0.5) / number, numPartitions=partitions(spark)).fit(chunks)
        found = model.freqItemsets.where(F.size("items") <= MAX_TOKENS).select(F.array_sort("items").alias("tokens"))
    found = reliable_checkpoint(_posted(found, single))
    hit = kept.select("items", "n", "bad", F.explode("items").alias("rarest")).join(found, "rarest").where(F.forall("tokens", lambda t: F.array_contains("items", t)))
    counted = hit.groupBy("tokens").agg(F.sum("n").alias("freq"), F.sum("bad").alias("hits")).unionByName(sure)
    rules = counted.where(F.col("hits") >= least).select("tokens", (F.col("hits") / F.col("freq")).alias("confidence"), (F.col("hits") / F.lit(max(total, 1))).alias("support"))
    rules = reliable_checkpoint(rules.where(F.col("confidence") >= min_confidence))
    # a rule goes if some of its tokens alone make a rule that is at least as confident (that one is as frequent, too)
    parts = F.expr("transform(sequence(1, shiftleft(1, size(tokens)) - 2), m -> filter(tokens, (x, i) -> shiftright(m, i) & 1 = 1))")
    shorter = rules.where(F.size("tokens") > 1).select(F.col("tokens").alias("whole"), "confidence", F.explode(parts).alias("part"))
    general = rules.select(F.col("tokens").alias("part"), F.col("confidence").alias("c"))
    worse = shorter.join(general, "part").where(F.col("c") >= F.col("confidence")).select(F.col("whole").alias("tokens")).distinct()
    left = _posted(rules.join(worse, "tokens", "left_anti"), single)
    return reliable_checkpoint(left.select(F.array_join("tokens", " ").alias("rule"), "tokens", "rarest", "confidence", "support"))


def _posted(combinations: DataFrame, single: DataFrame) -> DataFrame:
    """The inverted index: every combination under its rarest token (single: t and its freq)."""
    rare = combinations.select("tokens", F.explode("tokens").alias("t")).join(single, "t").groupBy("tokens").agg(F.min(F.struct("freq", "t")).alias("x"))
    return combinations.join(rare, "tokens").withColumn("rarest", F.col("x.t")).drop("x")


def match(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """items, mined (rule), confidence: for distinct token sets, the best rule found through the index."""
    posted = sets.select("items", F.explode("items").alias("rarest")).join(rules, "rarest")
    hits = posted.where(F.forall("tokens", lambda t: F.array_contains("items", t)))
    best = hits.groupBy("items").agg(F.min(F.struct((-F.col("confidence")).alias("c"), "rule")).alias("x"))
    return best.select("items", F.col("x.rule").alias("mined"), (-F.col("x.c")).alias("confidence"))


def judge(pages: DataFrame, labelled: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict, mined, confidence of every url."""
    rules = mine(labelled)
    d = pages.select("page_id", "url", tokens(F.col("url")).alias("items"))
    sets = reliable_checkpoint(d.groupBy("items").count().drop("count"))
    found = reliable_checkpoint(match(sets, rules))
    d = d.join(found, "items", "left").withColumns({"host": F.coalesce(host(F.col("url")), F.lit("")), "path": F.coalesce(path(F.col("url")), F.lit(""))})
    fixed = fixed_rule(F.col("host"), F.col("path"))
    learned = F.when(F.col("mined").isNotNull(), "block").otherwise("allow")
    return d.select(
        "page_id", "host", "path", fixed["rule"].alias("rule"), F.coalesce(fixed["verdict"], learned).alias("verdict"), "mined", "confidence"
    )


def labelled_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """url, bad: pages whose path names a labelled document by number; bad is toxic or of low quality."""
    number = F.regexp_extract(path(F.col("url")), r"/([0-9]{1,18})(?:\.[A-Za-z0-9]+)?/?$", 1)
    p = pages.select("url", number.alias("n")).select("url", F.expr("try_cast(n AS BIGINT)").alias("doc_id"))
    judged = labels.groupBy("doc_id").agg(F.max((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("bad"))
    return p.join(judged, "doc_id").select("url", "bad")

"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Targets: sources in code point order (null last) weigh 1, 2, 3, repeating, and
share all words; a target stops at MAX_REPEAT times its source's words and the
excess is shared again by weight until none is above.

Blocks: a document belongs to one of BLOCKS blocks of its source by the first
digits of md5(seed, doc_id, text), so blocks in digit order are a random permutation
of the source.  A source takes whole passes over its blocks, then goes through one
more pass in md5 order and takes every document that still fits below the target,
so in the end no open document fits; the smallest open one comes on top if that
ends nearer.  The pass is made in rounds: a round takes what fits up to the first
document that goes beyond the target, sets that and all longer than what is left
aside, and the next goes on behind it.  What is left shrinks below a document met at
random, so rounds grow with the logarithm of a source's documents; they end when
nothing fits.  A round finds its cut among 16**CUT_DIGITS blocks and then among the
documents of one of them, so no task orders a whole source.

Rows equal in doc_id, text and source are one entry with their number; the target
may cut between them.

Splitting tree: the units (pass, block) a source takes are its exact quota.
The root holds all quotas; each node splits its units evenly between two
children by a multivariate-hypergeometric draw (one hypergeometric draw per
source given the units left), down to the output shards.  A shard draws its
quota of each source as the next units of that source's permuted order, so the
draws are disjoint, and orders its rows locally by a hash.

All randomness is a hash of seed, node and source: reruns agree.  Everything is
DataFrame and SQL functions.  One row per source, and one per source and unit
(at most MAX_REPEAT * BLOCKS each), is what the tree handles; documents only
meet it in joins on (source, unit).  Tables of one row per source are broadcast
while a count shows them small, so no source is gathered in one task.

Defined results: a null text has no words; a document without words has no
effect on targets and fits every pass that is cut; a null source is a source of its
own, a null doc_id an id like any other; of rows equal in doc_id, text and source
that are drawn in part, mixed_documents repeats the one that is first by a hash of
all its columns; no words at all give targets of zero; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souk.llm.common import WORD, partitions, small
from souk.session import reliable_checkpoint

MAX_REPEAT = 3
DIGITS = 3  # hex digits of a block
BLOCKS = 16**DIGITS
CUT_DIGITS = 4  # hex digits of the blocks among which a round finds its cut
SHARD_WORDS = 2_000_000  # words of an output shard, about; their number grows with the corpus
MIN_SHARDS = 16


def _digest(seed: int) -> Column:
    said = F.when(F.col("text").isNull(), "n").otherwise(F.concat(F.lit("t"), "text"))
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), said).cast("binary"))


def sizes(docs: DataFrame, seed: int) -> DataFrame:
    """doc_id, source, size (words), m (the permutation's digest) and n of every n documents equal in them."""
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select("doc_id", "source", words.alias("size"), _digest(seed).alias("m")).groupBy("doc_id", "source", "size", "m").agg(F.count(F.lit(1)).alias("n"))


def targets(sized: DataFrame) -> DataFrame:
    """One row per source: source, source_size, target, passes (whole ones) and rest (words of one more pass).

    The windows run over one row per source.
    """
    s = sized.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    s = s.withColumn("weight", (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % 3 + 1)
    s = s.withColumn("cap", F.col("source_size") * MAX_REPEAT)
    # sources fill up in the order of cap / weight: below the water level all others share
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, whole = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    share = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    s = s.withColumn("level", left / share)
    s = s.withColumn("water", F.first(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level")), ignorenulls=True).over(whole))
    s = s.withColumn("target", F.least(F.col("cap").cast("double"), F.coalesce(F.col("water") * F.col("weight"), F.col("cap").cast("double"))))
    passes = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(MAX_REPEAT))).otherwise(0)
    s = s.withColumn("passes", passes.cast("long"))
    rest = F.when(F.col("passes") < MAX_REPEAT, F.col("target") - F.col("passes") * F.col("source_size")).otherwise(0.0)
    return s.select("source", "source_size", "target", "passes", rest.alias("rest"), F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).alias("k"))


def _fit(d: DataFrame, state: DataFrame) -> DataFrame:
    """What is behind pos and fits the gap, of the sources of state."""
    words = F.col("size") * F.col("n")
    fit = d.select("k", "m", "size", words.alias("words")).join(small(state), "k")
    return fit.where((F.col("m") > F.col("pos")) & (F.col("size") <= F.col("gap")))


def _round(d: DataFrame, state: DataFrame) -> DataFrame:
    """k, gap, pos of every source with a document behind pos that fits the gap; cut, part, left.

    All that fit are taken up to cut (null: to the end); of the documents at cut, part; left is the gap after that.
    """
    block = F.substring("m", 1, CUT_DIGITS)
    passes = (F.col("upto") > F.col("gap")) & (F.col("upto") - F.col("words") <= F.col("gap"))
    by = _fit(d, state).groupBy("k", "gap", "pos", block.alias("b")).agg(F.sum("words").alias("words"))
    by = by.withColumn("upto", F.sum("words").over(Window.partitionBy("k").orderBy("b")))
    at = F.min(F.when(passes, F.struct("b", (F.col("upto") - F.col("words")).alias("start"))))
    cuts = reliable_checkpoint(by.groupBy("k", "gap", "pos").agg(F.max("upto").alias("all"), at.alias("at")).select("k", "gap", "pos", "all", "at.b", "at.start"))
    run = _fit(d, cuts).where(block == F.col("b"))
    run = run.withColumn("upto", F.col("start") + F.sum("words").over(Window.partitionBy("k").orderBy("m"))).where(passes)
    before = F.col("upto") - F.col("words")
    part = F.floor((F.col("gap") - before) / F.col("size")).cast("long")
    run = run.select("k", F.col("m").alias("cut"), part.alias("part"), (before + part * F.col("size")).alias("used"))
    return cuts.join(run, "k", "left").select("k", "gap", "pos", "cut", "part", (F.col("gap") - F.coalesce("used", "all")).alias("left"))


def copies(sized: DataFrame, target: DataFrame) -> DataFrame:
    """sized and its target, with extra: how many of the n equal documents are in the cut pass."""
    d = sized.withColumnRenamed("source", "__s").join(small(target), F.col("__s").eqNullSafe(F.col("source"))).drop("__s")
    d = reliable_checkpoint(d)
    state = reliable_checkpoint(target.where((F.col("rest") > 0) & (F.col("passes") < MAX_REPEAT)).select("k", F.col("rest").alias("gap"), F.lit("").alias("pos")))
    rounds = None
    while not state.isEmpty():
        made = reliable_checkpoint(_round(d, state))
        rounds = made if rounds is None else rounds.unionByName(made)
        state = made.where(F.col("cut").isNotNull()).select("k", F.col("left").alias("gap"), F.col("cut").alias("pos"))
    if rounds is None:
        return d.withColumn("extra", F.lit(0).cast("long"))
    # one row per source, with its rounds
    rounds = rounds.groupBy("k").agg(F.collect_list(F.struct("pos", "gap", "cut", "part")).alias("rounds"), F.min("left").alias("left"))
    d = d.join(small(reliable_checkpoint(rounds)), "k", "left").withColumn("left", F.coalesce("left", "rest"))
    hit = "filter(rounds, r -> m > r.pos AND size <= r.gap AND m <= coalesce(r.cut, m))"
    d = d.withColumn("hit", F.expr(f"get({hit}, 0)"))
    d = d.withColumn("extra", F.when(F.col("hit").isNull(), 0).when(F.col("hit.cut") == F.col("m"), F.col("hit.part")).otherwise(F.col("n")).cast("long")).drop("rounds", "hit")
    # nothing open fits any more: the smallest open document goes beyond the target, if that comes nearer
    open_ = d.where((F.col("extra") < F.col("n")) & (F.col("rest") > 0) & (F.col("passes") < MAX_REPEAT) & (F.col("size") - F.col("left") < F.col("left")))
    best = reliable_checkpoint(open_.groupBy("k").agg(F.min(F.struct("size", "m")).alias("fill")))
    chosen = F.coalesce(F.col("fill.m") == F.col("m"), F.lit(False)).cast("long")
    return d.join(small(best), "k", "left").withColumn("extra", F.col("extra") + chosen).drop("left", "fill")


# --- the splitting tree ---------------------------------------------------


def _log_factorial(x: str) -> str:
    """ln x! by Stirling's series at x + 8 (eight factors divided out)."""
    z = f"({x} + 8.0D)"
    series = f"(({z} + 0.5D) * ln({z}) - {z} + 0.9189385332046727D + 1.0D / (12 * {z}) - 1.0D / (360 * pow({z}, 3)))"
    return f"({series} - ln(({x} + 1.0D) * ({x} + 2.0D) * ({x} + 3.0D) * ({x} + 4.0D)) - ln(({x} + 5.0D) * ({x} + 6.0D) * ({x} + 7.0D) * ({x} + 8.0D)))"


def _draw(good: str, total: str, drawn: str, u: str) -> str:
    """A hypergeometric draw as SQL: of `drawn` out of `total` units, how many are among the `good` ones.

    Inverse transform over the values within twelve standard deviations of the mode, u uniform in [0, 1).
    """
    lo, hi = f"greatest(0L, {drawn} - ({total} - {good}))", f"least({good}, {drawn})"
    mode = f"CAST(floor(({drawn} + 1.0D) * ({good} + 1.0D) / ({total} + 2.0D)) AS BIGINT)"
    width = f"CAST(ceil(12 * sqrt({drawn} * 1.0D * {good} / greatest({total}, 1L) * ({total} - {good}) / greatest({total}, 1L)) + 12) AS BIGINT)"
    log_p = f"-({_log_factorial('x')} + {_log_factorial(f'({good} - x)')} + {_log_factorial(f'({drawn} - x)')} + {_log_factorial(f'({total} - {good} - {drawn} + x)')})"
    xs = f"sequence(greatest({lo}, {mode} - {width}), least({hi}, {mode} + {width}))"
    pairs = f"transform({xs}, x -> struct(x AS x, {log_p} AS l))"
    # subtract the largest logarithm, then walk up the cumulated weights
    return (
        f"aggregate(array({pairs}), 0L, (z, ps) -> "
        f"aggregate(array(array_max(transform(ps, p -> p.l))), 0L, (y, top) -> "
        f"aggregate(ps, struct(0.0D AS acc, {u} * aggregate(ps, 0.0D, (t, p) -> t + exp(p.l - top)) AS goal, -1L AS x), "
        f"(s, p) -> struct(s.acc + exp(p.l - top) AS acc, s.goal AS goal, if(s.x < 0 AND s.acc + exp(p.l - top) > s.goal, p.x, s.x) AS x), "
        f"s -> if(s.x < 0, element_at(ps, -1).x, s.x))))"
    )


def splitting_tree(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """shard, ks, quota from one row: ks the source numbers, quota their units, both arrays.

    Every node's units are dealt evenly to its shards; a child's share of each source is a hypergeometric draw.
    """
    nodes = quotas.select(F.lit(0).alias("lo"), F.lit(shards).alias("hi"), "quota", "ks")
    u = f"(pmod(xxhash64({seed}L, lo, hi, i), 1000000007L) / 1000000007.0D)"
    total = "aggregate(quota, 0L, (t, q) -> t + q)"
    for _ in range(max(0, (shards - 1).bit_length())):
        nodes = nodes.withColumn("mid", F.expr("CAST((lo + hi) / 2 AS INT)"))
        nodes = nodes.withColumn("share", F.expr(f"CAST(floor({total} * (mid - lo) / greatest(hi - lo, 1)) AS BIGINT)"))
        # walk the sources: units of all sources left, units of the first child left, its share so far
        step = _draw("element_at(quota, i)", "s.all", "s.mine", u)
        walk = (
            f"aggregate(sequence(1, size(quota)), struct({total} AS all, share AS mine, CAST(array() AS array<bigint>) AS got, 0L AS x), "
            f"(s0, i) -> aggregate(array(s0), s0, (z, s) -> aggregate(array({step}), s, (y, x) -> "
            f"struct(s.all - element_at(quota, i) AS all, s.mine - x AS mine, concat(s.got, array(x)) AS got, x AS x))), s -> s.got)"
        )
        nodes = nodes.withColumn("part", F.when(F.col("hi") - F.col("lo") > 1, F.expr(walk)).otherwise(F.col("quota")))
        child = "struct(lo AS lo, if(hi - lo > 1, mid, hi) AS hi, part AS quota, ks AS ks)"
        other = "struct(mid AS lo, hi AS hi, zip_with(quota, part, (q, l) -> q - l) AS quota, ks AS ks)"
        nodes = nodes.select(F.explode(F.expr(f"filter(array({child}, if(hi - lo > 1, {other}, NULL)), c -> c IS NOT NULL)")).alias("c")).select("c.*")
    return nodes.select(F.col("lo").alias("shard"), "ks", "quota")


def units(drawn: DataFrame, shards: int, seed: int) -> DataFrame:
    """k (source number), unit, shard: the tree's draw of every unit (pass * BLOCKS + block) that the sources take."""
    at = F.conv(F.substring("m", 1, DIGITS), 16, 10).cast("long")
    taken = drawn.where((F.col("passes") > 0) | (F.col("extra") > 0)).select("k", at.alias("b"), "passes", (F.col("extra") > 0).alias("extra"))
    by = taken.groupBy("k", "b").agg(F.max("passes").alias("passes"), F.max("extra").alias("extra"))
    by = by.select("k", F.explode(F.expr(f"transform(sequence(0L, passes - 1 + CAST(extra AS INT)), p -> p * {BLOCKS} + b)")).alias("unit"))
    ranked = by.withColumn("rank", F.row_number().over(Window.partitionBy("k").orderBy("unit")) - 1)
    ranked = reliable_checkpoint(ranked)
    quota = ranked.groupBy("k").count().agg(F.sort_array(F.collect_list(F.struct("k", "count"))).alias("q")).where(F.size("q") > 0)
    tree = splitting_tree(quota.select(F.transform("q", lambda x: x["k"]).alias("ks"), F.transform("q", lambda x: x["count"]).alias("quota")), shards, seed)
    share = tree.select("shard", F.explode(F.arrays_zip("ks", "quota")).alias("z")).select("shard", F.col("z.ks").alias("k"), F.col("z.quota").alias("n"))
    w = Window.partitionBy("k").orderBy("shard").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    share = share.withColumn("upto", F.sum("n").over(w)).where(F.col("n") > 0)
    ranks = share.select("k", "shard", F.explode(F.expr("sequence(upto - n, upto - 1)")).alias("rank"))
    return ranked.join(ranks, ["k", "rank"]).select("k", "unit", "shard")


def mix(docs: DataFrame, seed: int = 1, shards: int | None = None) -> tuple[DataFrame, DataFrame, int]:
    """(plan, rows, shards): plan has size, target, n, passes and extra of all entries; rows one row per entry and pass it is drawn in.

    An entry is all n documents equal in doc_id, text and source.
    rows: doc_id, m, source, k, size, epoch, n, copies (how many of the n), shard, place (order within the shard).
    """
    sized = reliable_checkpoint(sizes(docs, seed))
    target = reliable_checkpoint(targets(sized))
    if shards is None:
        words = target.agg(F.sum("source_size")).first()[0] or 0  # one number
        shards = max(MIN_SHARDS, -(-words // SHARD_WORDS))
    plan = reliable_checkpoint(copies(sized, target))
    at = F.conv(F.substring("m", 1, DIGITS), 16, 10).cast("long")
    drawn = plan.where((F.col("passes") > 0) | (F.col("extra") > 0))
    drawn = drawn.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("passes") - 1 + (F.col("extra") > 0).cast("long"))))
    drawn = drawn.withColumn("copies", F.when(F.col("epoch") < F.col("passes"), F.col("n")).otherwise(F.col("extra")))
    drawn = drawn.withColumn("unit", F.col("epoch") * BLOCKS + at).join(reliable_checkpoint(units(plan, shards, seed)), ["k", "unit"])
    place = F.xxhash64(F.lit(seed), "shard", "m", "epoch")
    return plan, drawn.select("doc_id", "m", "source", "k", "size", "epoch", "n", "copies", "shard", place.alias("place")), shards


def report(docs: DataFrame, seed: int = 1, shards: int | None = None) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    plan, rows, _ = mix(docs, seed, shards)
    took = rows.groupBy("k", "m").agg(F.sum("copies").alias("copies"))
    p = plan.select("k", "m", "doc_id", "size", "source_size", "target", "n").join(took, ["k", "m"], "left").withColumn("copies", F.coalesce("copies", F.lit(0)))
    p = p.withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    often = F.floor(F.col("copies") / F.col("n")) + (F.col("i") <= F.col("copies") % F.col("n")).cast("long")
    return p.select("doc_id", "size", "source_size", "target", (F.col("size") * often).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, seed: int = 1, shards: int | None = None) -> DataFrame:
    """The documents of the mix, repeats included, in shards that are shuffled locally; same columns."""
    _, rows, shards = mix(docs, seed, shards)
    rows = reliable_checkpoint(rows.select(F.col("m").alias("__mx_m"), F.col("source").alias("__mx_src"), "n", F.col("copies").alias("__mx_c"), F.col("shard").alias("__mx_s"), F.col("place").alias("__mx_p")))
    whole, part = (rows.where(c).drop("n") for c in (F.col("__mx_c") == F.col("n"), F.col("__mx_c") < F.col("n")))
    d = docs.withColumn("__mx_d", _digest(seed))
    same = (F.col("__mx_d") == F.col("__mx_m")) & docs["source"].eqNullSafe(F.col("__mx_src"))
    out = d.join(whole, same).select(*docs.columns, "__mx_s", "__mx_p")
    if not part.isEmpty():  # at most one entry per source and round
        row = F.struct(*docs.columns)
        one = d.join(small(part), same).groupBy("__mx_m", "__mx_src", "__mx_c", "__mx_s", "__mx_p").agg(F.min_by(row, F.xxhash64(*docs.columns)).alias("__mx_row"))
        out = out.unionByName(one.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__mx_c")))).select("__mx_row.*", "__mx_s", "__mx_p"))
    return out.repartition(max(shards, partitions(docs.sparkSession)), "__mx_s").sortWithinPartitions("__mx_s", "__mx_p").select(*docs.columns)


ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
                  md5('1:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || CASE WHEN text IS NULL THEN 'n' ELSE 't' || text END) AS m FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM d GROUP BY source),
o AS (SELECT *, 3 * source_size AS cap, row_number() OVER (ORDER BY 3 * source_size / w, source NULLS LAST) AS r FROM s),
l AS (SELECT a.*, ((SELECT sum(source_size) FROM o) - coalesce((SELECT sum(b.cap) FROM o b WHERE b.r < a.r), 0))
             / ((SELECT sum(w) FROM o) - coalesce((SELECT sum(b.w) FROM o b WHERE b.r < a.r), 0)) AS level FROM o a),
t AS (SELECT *, least(CAST(cap AS DOUBLE), coalesce((SELECT arg_min(x.level, x.r) FROM l x WHERE x.level * x.w <= x.cap) * w, CAST(cap AS DOUBLE))) AS target FROM l),
p AS (SELECT *, CASE WHEN source_size > 0 THEN least(3, CAST(floor(target / source_size) AS BIGINT)) ELSE 0 END AS passes FROM t),
q AS MATERIALIZED (SELECT *, CASE WHEN passes < 3 THEN target - passes * source_size ELSE 0 END AS rest, row_number() OVER () AS k FROM p),
c AS MATERIALIZED (SELECT d.*, q.k, q.source_size, q.target, q.passes, q.rest, row_number() OVER (PARTITION BY q.k ORDER BY m) AS n
      FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source),
r(k, i, pos, gap) AS (
  SELECT k, 0, CAST(0 AS BIGINT), CAST(rest AS DOUBLE) FROM q WHERE rest > 0
  UNION ALL
  SELECT k, i + 1, min(n) FILTER (upto > gap), gap - coalesce(max(upto) FILTER (upto <= gap), 0)
  FROM (SELECT r.k, r.i, r.gap, c.n, sum(c.size) OVER (PARTITION BY r.k ORDER BY c.n) AS upto
        FROM r JOIN c ON c.k = r.k AND c.n > r.pos AND c.size <= r.gap) GROUP BY k, i, gap),
e AS (SELECT *, lead(pos) OVER (PARTITION BY k ORDER BY i) AS cut FROM r),
x AS (SELECT c.*, EXISTS (SELECT 1 FROM e WHERE e.k = c.k AND c.n > e.pos AND c.n < coalesce(e.cut, c.n + 1) AND c.size <= e.gap) AS below,
             (SELECT min(gap) FROM r WHERE r.k = c.k) AS gap FROM c),
y AS (SELECT *, NOT below AND coalesce(size - gap < gap, false) AS open FROM x),
z AS (SELECT *, below OR (open AND row_number() OVER (PARTITION BY k, open ORDER BY size, m) = 1) AS extra FROM y)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(size * (passes + CASE WHEN extra THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM z
"""

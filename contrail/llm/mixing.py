"""Mixing sources to target weights (DataFrame functions only).

Every source is a stream of words: its documents one after the other in a seeded random order,
cut into blocks of equally many words. A source's target says how many blocks it gives (each
block once per pass, at most ``epochs`` passes), so the block quotas are exact. A splitting
tree deals them to the output shards: a node with counts q_1 .. q_S over its sources gives its
left half a multivariate hypergeometric draw of as many blocks as that half has slots, and the
right half the rest, down to single shards. Quotas per source and sizes per shard are kept
exactly, and every shard is a fair sample of the whole mix. A shard's quota of a source is a
stretch of that pass's random order of the blocks, disjoint from the other shards', and its
blocks get random slots in the shard.

Nothing is collected: sums before a row are found within hash buckets of about the square root
of all rows, and from the buckets' totals; the multivariate draws go through groups of at most
``FANOUT`` sources. Random numbers are hashes of (seed, place), so reruns agree.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from contrail.llm.common import cut, free_name

WORD = r"[^\x20\x09-\x0D]+"
FANOUT = 256
#: ln(k!) for the k below which Stirling's series is not used.
SMALL = [math.lgamma(k + 1) for k in range(16)]


def let(value: Column, then) -> Column:
    """``then`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def uniform(*parts) -> Column:
    """A number in [0, 1) from the hash of the parts."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / float(1 << 53)


def ln_factorial(k: Column) -> Column:
    x = F.greatest(k.cast("double"), F.lit(1.0))
    series = x * F.log(x) - x + 0.5 * F.log(2 * math.pi * x) + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * F.pow(x, F.lit(5.0)))
    return F.when(k < len(SMALL), F.get(F.array(*map(F.lit, SMALL)), k.cast("int"))).otherwise(series)


def hypergeometric(total: Column, good: Column, n: Column, u: Column) -> Column:
    """How many of ``n`` draws without return from ``total`` items, ``good`` of them marked, are
    marked: inversion of ``u`` from the mode outwards, by the ratios of neighbouring chances.

    The walk is as long as 12 standard deviations. The chance of the mode is a sum of
    logarithms (Stirling), right to about 1e-4 of itself at 10^10 items; the draw always lies
    in the support.
    """
    least, most = F.greatest(F.lit(0).cast("long"), n + good - total), F.least(n, good)
    mode = F.greatest(least, F.least(most, F.floor((n + 1).cast("double") * (good + 1) / (total + 2)).cast("long")))

    def walk(v: Column) -> Column:
        N, K, m, k, lo, hi = (v[c] for c in ("all", "good", "picks", "mode", "lo", "hi"))
        choose = lambda a, b: ln_factorial(a) - ln_factorial(b) - ln_factorial(a - b)
        chance = F.exp(choose(K, k) + choose(N - K, m - k) - choose(N, m))
        spread = F.sqrt(m.cast("double") * K * (N - K) / N * (N - m) / N / F.greatest(N - 1, F.lit(1)))
        steps = F.least(hi - lo, F.ceil(12 * spread + 20))
        start = F.struct((v["u"] - chance).alias("u"), k.alias("a"), chance.alias("pa"), k.alias("b"), chance.alias("pb"),
                         F.when(v["u"] < chance, k).alias("got"))

        def step(s: Column, _: Column) -> Column:
            a, b = s["a"].cast("double"), s["b"].cast("double")
            up = F.when(s["a"] < hi, s["pa"] * (K - a) * (m - a) / ((a + 1) * (N - K - m + a + 1))).otherwise(0.0)
            down = F.when(s["b"] > lo, s["pb"] * b * (N - K - m + b) / ((K - b + 1) * (m - b + 1))).otherwise(0.0)
            return let(F.struct(up.alias("up"), down.alias("down")), lambda p: F.struct(
                (s["u"] - p["up"] - p["down"]).alias("u"), F.least(s["a"] + 1, hi).alias("a"), p["up"].alias("pa"),
                F.greatest(s["b"] - 1, lo).alias("b"), p["down"].alias("pb"),
                F.when(s["got"].isNotNull(), s["got"]).when(s["u"] < p["up"], s["a"] + 1).when(s["u"] < p["up"] + p["down"], s["b"] - 1).alias("got")))

        walked = F.aggregate(F.sequence(F.lit(0).cast("long"), steps), start, step)
        return F.coalesce(walked["got"], k)

    return let(F.struct(total.alias("all"), good.alias("good"), n.alias("picks"), mode.alias("mode"), least.alias("lo"), most.alias("hi"), u.alias("u")), walk)


def before(rows: DataFrame, group: list[str], key: str, ties: list[str], weight: str, buckets: Column, out: str) -> DataFrame:
    """Adds ``out``: the sum of ``weight`` over the rows of the same group before this one, in the order
    of (bucket of ``key``, ``key``, ``ties``). One shuffle of the rows, by (group, bucket)."""
    rows = rows.withColumn("_bucket", F.pmod(F.col(key), buckets))
    earlier = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = (rows.groupBy(*group, "_bucket").agg(F.sum(weight).alias("_sum"))
             .select(*group, "_bucket", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base")))
    within = Window.partitionBy(*group, "_bucket").orderBy(key, *ties).rowsBetween(Window.unboundedPreceding, -1)
    return (rows.join(bases, [*group, "_bucket"])
            .withColumn(out, F.col("_base") + F.coalesce(F.sum(weight).over(within), F.lit(0))).drop("_bucket", "_base"))


def weighted(sizes: DataFrame, pattern=(3, 1, 2)) -> DataFrame:
    """Adds ``rank`` (of ``source``, by code point, NULL last) and ``weight`` (``pattern``, repeating)."""
    ordered = cut(sizes.orderBy(F.asc_nulls_last("source")).withColumn("_at", F.monotonically_increasing_id()), "mixing-sources")
    task = F.shiftright("_at", 33)  # the id is (task, place in the task)
    counts = ordered.groupBy(task.alias("_task")).count()
    bases = counts.select("_task", F.coalesce(F.sum("count").over(
        Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    ranked = (ordered.withColumn("_task", task).join(bases, "_task")
              .withColumn("rank", F.col("_base") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_task", "_base", "_at"))
    place = (F.col("rank") % len(pattern)).cast("int")
    return ranked.withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in pattern]), place))


def with_targets(sources: DataFrame, share: float, epochs: int) -> DataFrame:
    """Adds ``target``: ``share`` of all words by weight, at most ``epochs`` times a source's words, the
    excess reshared by weight until no source is above. A round fetches three sums."""
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    cap, weight = epochs * F.col("source_size"), F.col("weight")
    rate, full = 0.0, -1
    while True:
        over = cap <= rate * weight
        capped, spare, n = sources.agg(F.coalesce(F.sum(F.when(over, cap)), F.lit(0)), F.sum(F.when(over, 0.0).otherwise(weight)),
                                       F.count(F.when(over, 1))).first()
        if n == full or not spare:
            break
        rate, full = (share * total - capped) / spare, n
    return sources.withColumn("target", F.least(cap.cast("double"), rate * weight))


def split_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """(rank, quota) -> (shard, rank, quota): the splitting tree, one level of shard halves at a time."""
    sources, total = quotas.agg(F.coalesce(F.max("rank"), F.lit(0)) + 1, F.coalesce(F.sum("quota"), F.lit(0))).first()
    slots = lambda i: F.floor(F.lit(total).cast("decimal(38,0)") * i / shards).cast("long")
    rows = quotas.where("quota > 0").select(F.lit(0).cast("long").alias("lo"), F.lit(shards).cast("long").alias("hi"), "rank", F.col("quota").alias("q"))
    for level in range((shards - 1).bit_length()):
        mid = F.floor((F.col("lo") + F.col("hi")) / 2)
        tiers, width = [rows.where("hi - lo > 1").select("lo", "hi", F.col("rank").alias("r"), "q")], sources
        while width > 1 or len(tiers) == 1:
            inner = tiers[-1].groupBy("lo", "hi", F.floor(F.col("r") / FANOUT).alias("p")).agg(
                F.array_sort(F.collect_list(F.struct("r", "q"))).alias("kids"), F.sum("q").alias("q"))
            tiers.append(inner.withColumnRenamed("p", "r"))
            width = -(-width // FANOUT)
        drawn = tiers[-1].withColumn("x", slots(mid) - slots(F.col("lo")))

        for tier in range(len(tiers) - 1, 0, -1):
            place = [F.lit(seed), F.lit(level), F.lit(tier), F.col("lo")]

            def give(state: Column, kid: Column) -> Column:
                u = uniform(*place, kid["r"])  # noqa: B023
                return let(hypergeometric(state["all"], kid["q"], state["picks"], u), lambda x: F.struct(
                    (state["all"] - kid["q"]).alias("all"), (state["picks"] - x).alias("picks"),
                    F.concat(state["out"], F.array(F.struct(kid["r"].alias("r"), kid["q"].alias("q"), x.alias("x")))).alias("out")))

            start = F.struct(F.col("q").alias("all"), F.col("x").alias("picks"), F.array().cast("array<struct<r:bigint,q:bigint,x:bigint>>").alias("out"))
            kids = drawn.select("lo", "hi", F.explode(F.aggregate("kids", start, give, lambda s: s["out"])).alias("k")).select("lo", "hi", "k.r", "k.q", "k.x")
            drawn = kids if tier == 1 else kids.drop("q").join(tiers[tier - 1], ["lo", "hi", "r"])
        halves = F.explode(F.array(F.struct(F.col("lo").alias("lo"), mid.alias("hi"), F.col("x").alias("q")),
                                   F.struct(mid.alias("lo"), F.col("hi").alias("hi"), (F.col("q") - F.col("x")).alias("q"))))
        split = drawn.select(F.col("r").alias("rank"), halves.alias("h")).select("h.lo", "h.hi", "rank", "h.q").where("q > 0")
        rows = cut(split.unionByName(rows.where("hi - lo <= 1")), "mixing-split")
    return rows.select(F.col("lo").alias("shard"), "rank", F.col("q").alias("quota"))


def mix(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", pattern=(3, 1, 2),
        share: float = 1.5, epochs: int = 2, block_words: int = 4096, least_blocks: int = 1024, seed: int = 17) -> tuple[DataFrame, DataFrame]:
    """The mix of ``docs``, and what it takes of every document.

    The first frame has a row per slice (shard, slot, pass, source, id, start, length): words start to
    start + length of a document stand in this slot of this shard; slots are gapless from 0 in a
    shard, a slot is one block, its slices follow each other by (``at``). The second has a row
    per row of ``docs``: id, size, source, source_size, target, taken. A source's blocks have ``block_words`` words, or
    fewer so that it has about ``least_blocks``; the last block taken is cut, so a source gives its
    target rounded to whole words.

    Defined cases: a NULL or empty text has size 0 and gives nothing; a NULL source is a source of
    its own, the last; repeated rows are taken each on its own; an empty table gives empty
    frames. Extra columns are not read.
    """
    text = F.col(f"`{text_col}`")
    read = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").cast("string").alias("source"),
                       F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                       F.xxhash64(F.lit(seed), F.col(f"`{id_col}`").cast("string"), text).alias("h"))
    rows = cut(read, "mixing-rows")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.when(F.col("size") > 0, 1)).alias("n"))
    sources = with_targets(weighted(sizes, pattern), share, epochs)
    size, width = F.col("source_size"), F.col("width")
    full = F.expr("source_size div width")
    take = F.round("target").cast("long")
    sources = (sources.withColumn("width", F.greatest(F.lit(1).cast("long"), F.least(F.lit(block_words).cast("long"), F.floor(size / least_blocks))))
               .withColumns({"full": full, "blocks": F.expr("(source_size + width - 1) div width"), "passes": F.when(size > 0, F.floor(take / size)).otherwise(0).cast("long")})
               .withColumn("rest", take - F.col("passes") * size)
               .withColumn("quota", F.col("passes") * F.col("blocks") + F.ceil(F.col("rest") / width)))
    sources = cut(sources, "mixing-targets")
    n, many, total = sources.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("quota"), F.lit(0)), F.count("*")).first()
    per = lambda k: max(256, math.isqrt(k))

    # Where each shard's stretch of a source begins: at most one number per shard.
    leaves = split_quotas(sources.select("rank", "quota"), shards, seed)
    bounds = (leaves.withColumn("first", F.coalesce(F.sum("quota").over(
        Window.partitionBy("rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .groupBy("rank").agg(F.array_sort(F.collect_list(F.struct("first", "shard"))).alias("stretches")))

    # The blocks of every pass in a random order; the short last block of a source stands last.
    runs = F.explode(F.sequence(F.lit(0).cast("long"), F.col("passes") - F.when(F.col("rest") > 0, 0).otherwise(1)))
    chunk = 4096
    chunks = (sources.where("quota > 0").select("*", runs.alias("pass")).withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("blocks") - 1) / chunk))))
              .repartition("rank", "pass", "chunk"))
    blocks = chunks.withColumn("block", F.explode(F.sequence(F.col("chunk") * chunk, F.least(F.col("chunk") * chunk + chunk, F.col("blocks")) - 1)))
    blocks = blocks.select("rank", "pass", "block", "width", "full", "blocks", "passes", "rest", "source_size", F.lit(1).alias("one"),
                           F.xxhash64(F.lit(seed), F.lit("block"), "rank", "pass", "block").alias("key"))
    whole = before(blocks.where("block < full"), ["rank", "pass"], "key", ["block"], "one", F.ceil(F.col("full") / per(many)), "place")
    last = blocks.where("block >= full").withColumn("place", F.col("full"))
    words = F.least(F.col("width"), F.col("source_size") - F.col("block") * F.col("width"))
    left = F.when(F.col("pass") < F.col("passes"), words).otherwise(F.least(words, F.col("rest") - F.col("place") * F.col("width")))
    taken = (whole.unionByName(last).withColumn("words", left).where("words > 0").join(bounds, "rank")
             .withColumn("draw", F.col("pass") * F.col("blocks") + F.col("place")))
    own = F.filter("stretches", lambda s: s["first"] <= F.col("draw"))
    taken = taken.select("rank", "pass", "block", "words", "one", F.element_at(own, -1)["shard"].alias("shard"),
                         F.xxhash64(F.lit(seed), F.lit("slot"), "rank", "pass", "block").alias("key"))
    drawn = cut(before(taken, ["shard"], "key", ["rank", "pass", "block"], "one", F.lit(max(1, -(-many // (shards * per(many))))), "slot")
                .drop("one", "key"), "mixing-drawn")

    # The documents of a source one after the other, and the blocks each of them lies in.
    known = sources.select("source", "rank", "source_size", "target", "width", F.col("n").alias("texts")).withColumnRenamed("source", "_source")
    named = rows.join(known, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    placed = before(named.where("size > 0"), ["rank"], "h", ["size", "id"], "size", F.ceil(F.col("texts") / per(n)), "at")
    end = F.col("at") + F.col("size")
    pieces = placed.withColumn("block", F.explode(F.sequence(F.floor(F.col("at") / width), F.floor((end - 1) / width))))
    low = F.greatest(F.col("at"), F.col("block") * width)
    met = pieces.join(drawn, ["rank", "block"], "left").withColumn("low", low).withColumn(
        "length", F.greatest(F.lit(0).cast("long"), F.least(end, F.col("block") * width + F.coalesce("words", F.lit(0))) - F.col("low")))
    met = cut(met.select("shard", "slot", "pass", "source", "id", "rank", "at", "size", "source_size", "target",
                         (F.col("low") - F.col("at")).alias("start"), "length"), "mixing-slices")
    out_id = free_name(["shard", "slot", "pass", "source", "at", "start", "length", "size", "source_size", "target", "taken"], id_col)
    slices = met.where("length > 0").select("shard", "slot", "pass", "source", F.col("id").alias(out_id), (F.col("at") + F.col("start")).alias("at"), "start", "length")
    keys = ["id", "size", "source", "source_size", "target"]
    got = met.groupBy("rank", "at", *keys).agg(F.sum("length").alias("taken")).select(*keys, "taken")
    none = named.where("size = 0").select(*keys, F.lit(0).cast("long").alias("taken"))
    return slices, got.unionByName(none).withColumnRenamed("id", out_id)


def slice_text(text: Column, start: Column, length: Column) -> Column:
    """The words of a slice, joined by spaces."""
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), (start + 1).cast("int"), length.cast("int")), " ")

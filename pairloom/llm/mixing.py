"""Mixing sources to target weights by Sainte-Lague apportionment.

1. Every source gets a target in words: its share by weight of all words, at most ``repeats`` times its own; what is
   above goes to the others by weight.
2. The documents of a source lie in shards by a seeded hash; the words of a shard, in seeded order, are cut into blocks of
   equal size. A target counts in blocks.
3. The blocks of the mix go to the sources one by one by the highest quotients target / (2k + 1), and those of a
   source to its shards in the same way: integer quotas per shard.
4. A shard takes each block as often as its quota allows for all, and once more the blocks that are first by a seeded hash.

All steps are DataFrame functions. Texts are read once, for their numbers of words. No quotient below those in question is
made: all but about the last two blocks of each party are certain beforehand.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from pairloom.session import hand_over, scratch, stage

WORD = r"[^\x20\x09-\x0D]+"
#: Words and rows of a shard, about; copies of a row that stay together; words of a block.
SHARD_WORDS, SHARD_ROWS, COPIES, BLOCK_WORDS = 1 << 20, 1 << 16, 64, 16


def document_sizes(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(id, source, size): the number of words of every text; null has none."""
    size = F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size"))


def numbered(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """``df`` with its rank from 0 in a total order; sorted in ranges, whose sizes alone are summed up."""
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = stage(df.orderBy(*order).withColumns({"_part": F.spark_partition_id(), "_inside": inside}), "ranked")
    ranges = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))  # at most one row per shuffle partition
    before = F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    ranges = F.broadcast(ranges.select("_part", F.coalesce(before, F.lit(0)).alias("_before")))
    return rows.join(ranges, "_part").withColumn(name, F.col("_before") + F.col("_inside")).drop("_part", "_inside", "_before")


def cyclic_weights(totals: DataFrame, cycle: Sequence[float] = (5, 2, 1)) -> DataFrame:
    """(source, weight): sources in code-point order, null last, weigh as the cycle says."""
    ranked = numbered(totals.select("source"), "at", F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(float(w)) for w in cycle])
    return ranked.select("source", F.element_at(weights, (F.col("at") % len(cycle) + 1).cast("int")).alias("weight"))


def targets(totals: DataFrame, repeats: int) -> DataFrame:
    """``totals`` (words, weight) with ``target``: shares of all words by weight, none above ``repeats`` times its words.

    The level, words per weight, rises while sources are cut off at their limit: at most once for each, and mostly a few
    times altogether. Each round is one aggregate of two numbers.
    """
    limit = repeats * F.col("words")
    everything = totals.agg(F.sum("words").alias("words")).first()["words"] or 0
    level, cut = 0.0, -1
    while True:
        at_limit = limit < level * F.col("weight")
        now = totals.agg(
            F.sum(F.when(at_limit, limit)).alias("spent"), F.sum(F.when(~at_limit, F.col("weight"))).alias("weight"),
            F.count(F.when(at_limit, 1)).alias("cut")).first()
        if now["cut"] == cut:
            break
        cut = now["cut"]
        if not now["weight"]:
            break  # nothing is left that could take more
        level = (everything - (now["spent"] or 0)) / now["weight"]
    at_limit = limit < level * F.col("weight")
    return totals.withColumn("target", F.when(at_limit, limit.cast("double")).otherwise(level * F.col("weight")))


def apportion(parties: DataFrame, seats: DataFrame, group: str, party: str, spare: int = 6) -> DataFrame:
    """(group, party, quota): the seats of each group, given by the highest quotients votes / (2k + 1), k = 0, 1, ...

    ``parties`` has (group, party, votes, limit), ``seats`` (group, seats). Ties go to the first party; none gets more than its limit,
    and seats that nobody may take stay free. The seats below the rounded share, less one, are certain; the rest is chosen among the
    next quotients of each party, ranked in ranges. If these prove too few, the choice is repeated with more.
    """
    sums = parties.groupBy(group).agg(F.sum("votes").alias("all_votes"), F.count(F.lit(1)).alias("n"))
    share = F.col("votes") / F.col("all_votes")
    sure = F.floor(F.col("votes") * F.col("seats") / F.col("all_votes") + 0.5) - 1
    known = parties.filter("votes > 0").join(sums, group).join(seats, group)
    known = stage(known.withColumn("sure", F.greatest(F.lit(0), F.least("limit", sure)).cast("long")), "sure")
    left = known.groupBy(group).agg((F.max("seats") - F.sum("sure")).alias("left"))
    while True:
        more = F.least(F.col("limit") - F.col("sure"), F.ceil(share * 2 * F.col("n")) + spare).cast("long")
        open_ = known.withColumn("more", more).filter("more > 0")
        quotients = open_.withColumn("k", F.explode(F.expr("sequence(sure, sure + more - 1)"))).select(
            group, party, (F.col("votes") / (2 * F.col("k") + 1)).alias("quotient"))
        ranked = stage(numbered(quotients, "rank", F.col(group), F.desc("quotient"), F.col(party)), "quotients")
        first = ranked.groupBy(group).agg(F.min("rank").alias("first"))
        chosen = ranked.join(first.join(left, group), group).filter("rank - first < left")
        won = chosen.groupBy(group, party).agg(F.count(F.lit(1)).alias("won"))
        quotas = stage(known.withColumn("more", more).join(won, [group, party], "left").withColumn("won", F.coalesce("won", F.lit(0))), "quotas")
        if quotas.filter("won > 0 AND won = more AND sure + more < limit").isEmpty():
            return quotas.select(group, party, (F.col("sure") + F.col("won")).alias("quota"))
        spare *= 8


def _key(*parts: Column | str) -> Column:
    """64 bits of a seeded hash, in hexadecimal digits."""
    return F.substring(F.md5(F.concat_ws(":", *parts).cast("binary")), 1, 16)


def mix(docs: DataFrame, weights: DataFrame | Sequence[float] = (5, 2, 1), repeats: int = 3, seed: int = 0, block_words: int = BLOCK_WORDS,
        id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(id, source, size, source_size, target, times, extra, taken) for every row: what the mix takes of it.

    ``weights`` are a cycle for the sources in code-point order, or rows (source, weight); a source without a row
    weighs nothing. All targets together are the size of ``docs``. The whole text is taken ``times`` times, and the intervals ``extra`` (numbers
    of the first and last word, from 0) once more; ``taken`` counts words with repeats. No text is taken more than ``repeats`` times.
    The same rows, weights and seed give the same result, however the rows are stored. A source is off its target by about half a block, and a
    tiny one by the rounding of its words to blocks.

    Null and empty texts have size 0 and give nothing; a null source is one of its own, after all others; null ids are like
    any other; equal rows stay rows of their own; other columns are ignored. An empty table gives no rows. Weights that
    are all 0 give a target of 0.
    """
    spark = docs.sparkSession
    with scratch(spark):
        sizes = document_sizes(docs, id_col, source_col, text_col)
        rows = stage(sizes.groupBy("source", "id", "size").agg(F.count(F.lit(1)).alias("copies")), "sizes")
        totals = stage(rows.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("words"), F.sum("copies").alias("rows")), "sources")
        given = weights if isinstance(weights, DataFrame) else cyclic_weights(totals, weights)
        given = given.select(F.col("source").alias("named"), F.col("weight").cast("double").alias("weight"))
        totals = totals.join(given, F.col("source").eqNullSafe(F.col("named")), "left").withColumn("weight", F.coalesce("weight", F.lit(0.0)))
        totals = stage(numbered(totals.drop("named"), "at", F.col("source").asc_nulls_last()), "sources")
        shards = F.greatest(F.lit(1), F.ceil(F.col("words") / SHARD_WORDS), F.ceil(F.col("rows") / SHARD_ROWS)).cast("long")
        totals = stage(targets(totals, repeats).withColumn("shards", shards), "targets")

        # A row that occurs a million times is dealt out in small lots.
        lots = rows.withColumn("lot", F.explode(F.expr(f"sequence(0L, (copies - 1) div {COPIES})")))
        lots = lots.withColumn("copies", F.least(F.lit(COPIES), F.col("copies") - COPIES * F.col("lot")).cast("long"))
        spread = totals.select(F.col("source").alias("named"), "at", "shards")
        lots = lots.join(spread, F.col("source").eqNullSafe(F.col("named"))).drop("named").withColumn(
            "key", _key(F.lit(str(seed)), F.coalesce(F.col("id").cast("string"), F.lit("")), F.col("size"), F.col("lot")))
        point = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
        lots = lots.withColumn("shard", F.shiftright(point * F.col("shards"), 32))
        order = Window.partitionBy("at", "shard").orderBy("key", "id", "size", "lot").rowsBetween(Window.unboundedPreceding, -1)
        before = F.coalesce(F.sum(F.col("size") * F.col("copies")).over(order), F.lit(0))
        lots = stage(lots.select("at", "shard", "id", "size", "copies", before.alias("start")), "lots")

        blocks = F.expr(f"(words + {block_words - 1}) div {block_words}")
        parts = lots.groupBy("at", "shard").agg(F.sum(F.col("size") * F.col("copies")).alias("words")).filter("words > 0")
        parts = stage(parts.withColumn("blocks", blocks), "shards")
        owned = totals.join(parts.groupBy("at").agg(F.sum("blocks").alias("blocks")), "at")
        votes = F.col("target") * F.col("blocks") / F.col("words")
        owned = stage(owned.select(F.lit(0).alias("mix"), "at", votes.alias("votes"), (repeats * F.col("blocks")).alias("limit")), "votes")
        whole = owned.groupBy("mix").agg(F.floor(F.sum("votes") + 0.5).cast("long").alias("seats"))
        quotas = apportion(owned, whole, "mix", "at").select("at", F.col("quota").alias("seats"))
        owners = parts.select("at", "shard", F.col("blocks").cast("double").alias("votes"), (repeats * F.col("blocks")).alias("limit"))
        quotas = apportion(owners, quotas, "at", "shard")

        block_key = lambda i: _key(F.lit(str(seed)), F.lit("block"), F.col("at"), F.col("shard"), i)
        plan = parts.join(quotas, ["at", "shard"], "left").withColumn("quota", F.coalesce("quota", F.lit(0)))
        # Few bytes, but a hash for each block: dealt out by number, since by size they would be one task.
        plan = plan.repartition(min(10_000, -(-parts.count() // 4) or 1), "at", "shard")
        plan = plan.withColumns({"times": F.expr("quota div blocks"), "rest": (F.col("quota") % F.col("blocks")).cast("int")})
        keys = F.array_sort(F.transform(F.expr("sequence(0L, blocks - 1)"), block_key))
        plan = plan.withColumn("last_key", F.when(F.col("rest") > 0, F.element_at(keys, F.greatest("rest", F.lit(1)))))
        plan = stage(plan.select("at", "shard", "words", "blocks", "times", "last_key"), "plan")

        pieces = lots.join(plan, ["at", "shard"], "left").withColumn("copy", F.explode(F.expr("sequence(0L, copies - 1)")))
        pieces = pieces.withColumn("start", F.col("start") + F.col("copy") * F.col("size")).withColumn("end", F.col("start") + F.col("size"))
        block_of = lambda word: F.expr(f"(({word} + 1) * blocks - 1) div words")
        edge = lambda i: F.call_function("div", i * F.col("words"), F.col("blocks"))
        inside = F.filter(F.sequence(block_of("start"), block_of("end - 1")), lambda i: block_key(i) <= F.col("last_key"))
        some = (F.col("size") > 0) & F.col("last_key").isNotNull()
        clipped = F.transform(inside, lambda i: F.struct(
            (F.greatest(F.col("start"), edge(i)) - F.col("start")).alias("first"),
            (F.least(F.col("end"), edge(i + 1)) - 1 - F.col("start")).alias("last")))
        pieces = pieces.select(
            "at", "id", "size", F.coalesce("times", F.lit(0)).cast("long").alias("times"),
            F.when(some, clipped).otherwise(F.expr("CAST(array() AS array<struct<first:long,last:long>>)")).alias("extra"))
        extra = F.aggregate("extra", F.lit(0).cast("long"), lambda n, e: n + e["last"] - e["first"] + 1)
        made = pieces.join(totals.select("at", "source", F.col("words").alias("source_size"), "target"), "at")
        return hand_over(made.select(
            F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", "times", "extra",
            (F.col("times") * F.col("size") + extra).alias("taken")))

"""Mixing sources to target weights by Sainte-Lague apportionment. DataFrame functions only.

All sizes are in words. Sources share the words of the whole input by weight; none may get
more than ``REPEATS`` times what it has, and what it leaves goes to the others by weight.
The targets are then apportioned in whole blocks of equally many words: block after block
goes to the source with the highest quotient target / (2 * blocks + 1). Within a source its
shards, hash groups of about ``SHARD_ROWS`` documents, share the source's blocks in the same
way by their sizes. A shard lays its documents on a line in a seeded order, cut into blocks,
and takes its quota from the start, again from the start where the quota exceeds the line.

Quotients are never listed: how many of a party's lie above a bound is one division, so the
last quotient that wins is narrowed down by sums over the parties, ``GRID`` bounds at a time.
Only the quotients between the last two bounds are ranked; what lies above them is won. The
result is that of listing all, for any number of parties and sizes, and the work depends on
sources and shards, not on blocks. Only the table of sources is ordered as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tarmac.llm import durable

WEIGHTS = [1, 2, 3]  # of the sources in order, repeating
REPEATS = 3
SEED = 20240601
SHARD_ROWS = 2000
BLOCKS = 1 << 20  # blocks of the whole mix, about
LARGEST_BLOCK = 4096  # words
LEAST_BLOCKS = 16  # of the smallest source that has a target, about
GRID = 16  # bounds that are tried at once for the last winning quotient
NARROWINGS = 3
SLACK = 1e-9  # by which bounds are widened, more than any rounding


def _in_order() -> list[Column]:
    """Sources by code point, null last."""
    return [F.col("source").isNull(), F.col("source")]


def targets(sources: DataFrame, weights: list[int] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """``sources`` (source, source_size) with ``weight`` and ``target``, a double.

    Sources are filled by size for each unit of weight: the first that its cap does not stop
    sets the level of all that follow.
    """
    ranked = sources.withColumn("_rank", F.row_number().over(W.orderBy(*_in_order()))).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("_rank") - 1) % len(weights) + 1)
    )
    every = W.partitionBy()
    cap = F.col("source_size") * F.lit(float(repeats))
    filled = W.orderBy(F.col("_cap") / F.col("weight"), "_rank")
    before = filled.rowsBetween(W.unboundedPreceding, -1)
    after = filled.rowsBetween(W.currentRow, W.unboundedFollowing)
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    levels = ranked.withColumn("_cap", cap).withColumn("_level", level)
    free = F.min(F.when(F.col("_cap") >= F.col("_level") * F.col("weight"), F.struct(F.col("_cap") / F.col("weight"), "_rank", "_level"))).over(every)
    return levels.withColumn("target", F.least("_cap", free["_level"] * F.col("weight"))).drop("_cap", "_level")


def _above(votes: Column, bound: Column, strictly: bool) -> Column:
    """How many of the quotients votes / 1, votes / 3, votes / 5 ... exceed (or reach) the bound."""
    near = F.floor((votes / bound + 1) / 2)
    holds = (lambda k: votes / (2 * k + 1) > bound) if strictly else (lambda k: votes / (2 * k + 1) >= bound)
    # The division may round across an integer; the quotients beside it are tested themselves.
    return (near + holds(near).cast("long") - ((near > 0) & ~holds(near - 1)).cast("long")).cast("long")


def sainte_lague(parties: DataFrame, group: str | None, votes: str, seats: str, order: str) -> DataFrame:
    """``parties`` with ``blocks``: the seats each gets of its group's ``seats`` by highest quotients.

    ``order`` tells the parties of a group apart and breaks ties, lower first; a null group is a
    group. Parties without votes get nothing, and nobody anything where there are no votes.
    """
    key = F.lit("") if group is None else F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("null"))
    rows = durable.cut(parties.withColumn("_g", key).withColumn("_v", F.col(votes).cast("double")))
    voting = rows.filter("_v > 0")
    # The last winning quotient lies between all / (2 seats + parties) and all / (2 seats - parties).
    groups = voting.groupBy("_g").agg(
        F.sum("_v").alias("_all"), F.count("*").alias("_n"), F.max("_v").alias("_most"), F.max(seats).alias("_seats")
    )
    low = F.col("_all") / (2 * F.col("_seats") + F.col("_n")) * (1 - SLACK)
    spare = 2 * F.col("_seats") - F.col("_n")
    high = F.when(spare > 0, F.least("_most", F.col("_all") / spare)).otherwise(F.col("_most")) * (1 + SLACK)
    bounds = durable.cut(groups.select("_g", "_seats", low.alias("_low"), high.alias("_high")))
    for _ in range(NARROWINGS):
        bound = lambda j: F.col("_low") * F.pow(F.col("_high") / F.col("_low"), F.lit(j / GRID))
        sums = [F.sum(_above(F.col("_v"), bound(j), False)).alias(f"_{j}") for j in range(1, GRID)]
        counted = voting.join(bounds, "_g").groupBy("_g", "_seats", "_low", "_high").agg(*sums)
        step = F.lit(0)
        for j in range(1, GRID):
            step = step + (F.col(f"_{j}") >= F.col("_seats")).cast("int")
        counted = counted.withColumn("_step", step)
        at = lambda shift: F.col("_low") * F.pow(F.col("_high") / F.col("_low"), (F.col("_step") + shift) / GRID)
        bounds = durable.cut(counted.select("_g", "_seats", (at(0) * (1 - SLACK)).alias("_low"), (at(1) * (1 + SLACK)).alias("_high")))
    sure = _above(F.col("_v"), F.col("_high"), True)
    judged = voting.join(bounds, "_g").select("_g", order, "_v", "_seats", sure.alias("_sure"), _above(F.col("_v"), F.col("_low"), False).alias("_may"))
    judged = durable.cut(judged)
    won = judged.groupBy("_g").agg((F.max("_seats") - F.sum("_sure")).alias("_open"))
    last = judged.filter("_may > _sure").withColumn("_k", F.explode(F.sequence(F.col("_sure"), F.col("_may") - 1)))
    best = W.partitionBy("_g").orderBy((F.col("_v") / (2 * F.col("_k") + 1)).desc(), order, "_k")
    more = last.withColumn("_place", F.row_number().over(best)).join(won, "_g").filter("_place <= _open")
    more = more.groupBy("_g", order).agg(F.count("*").alias("_more"))
    seated = judged.select("_g", order, "_sure").join(more, ["_g", order], "left")
    seated = seated.select("_g", order, (F.col("_sure") + F.coalesce("_more", F.lit(0))).alias("blocks"))
    joined = rows.join(seated, ["_g", order], "left")
    return joined.select(*parties.columns, F.coalesce("blocks", F.lit(0)).cast("long").alias("blocks"))


def mix(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, taken, source.

    ``taken`` is how many words the mix takes of the document, repeats counted. A null or
    empty text has size 0 and is not taken; a null source is a source of its own. Rows with
    a repeated or null id stay apart rows. Extra columns are ignored.
    """
    text = F.coalesce("text", F.lit(""))
    sized = durable.cut(
        docs.select(
            "doc_id",
            "source",
            F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size"),
            F.xxhash64(F.lit(SEED), "doc_id", text).alias("_draw"),
        )
    )
    sources = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_rows")))
    every = W.partitionBy()
    total = F.sum("source_size").over(every)
    smallest = F.min(F.when(F.col("target") > 0, F.col("target"))).over(every)
    most = F.least(F.lit(LARGEST_BLOCK), F.floor(total / BLOCKS), F.floor(smallest / LEAST_BLOCKS))
    block = F.greatest(F.lit(1), most).cast("long")
    sources = sources.withColumn("_block", block).withColumn("_all", F.round(total / F.col("_block")).cast("long"))
    sources = sainte_lague(sources, None, "target", "_all", "_rank")
    shards_of = F.greatest(F.lit(1), F.ceil(F.col("_rows") / SHARD_ROWS)).cast("long")
    sources = durable.cut(
        sources.select(F.col("source").alias("_source"), "source_size", "target", F.col("blocks").alias("_source_blocks"), "_block", shards_of.alias("_shards"))
    )
    dealt = sized.join(sources, sized["source"].eqNullSafe(sources["_source"])).withColumn(
        "_shard", F.pmod("_draw", "_shards")
    )
    shards = dealt.groupBy("_source", "_shard", "source_size", "_source_blocks", "_block").agg(F.sum("size").alias("_size"))
    shards = sainte_lague(shards, "_source", "_size", "_source_blocks", "_shard")
    quota = F.least(F.col("blocks") * F.col("_block"), F.col("_size") * REPEATS)
    shards = shards.select(F.col("_source").alias("_s"), F.col("_shard").alias("_n"), "_size", quota.alias("_quota"))
    rows = dealt.join(shards, dealt["_source"].eqNullSafe(shards["_s"]) & (dealt["_shard"] == shards["_n"]))
    line = W.partitionBy("_s", "_n").orderBy("_draw", "doc_id", "size").rowsBetween(W.unboundedPreceding, W.currentRow)
    rounds = F.when(F.col("_size") > 0, F.floor(F.col("_quota") / F.greatest("_size", F.lit(1)))).otherwise(0).cast("long")
    rest = F.col("_quota") - rounds * F.col("_size") - (F.sum("size").over(line) - F.col("size"))
    taken = rounds * F.col("size") + F.greatest(F.lit(0), F.least(rest, F.col("size")))
    return rows.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), "source")

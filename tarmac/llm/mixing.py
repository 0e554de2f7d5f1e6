"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Documents of each source fall into blocks by a hash of their id. A source's
target says how many blocks are drawn: whole epochs over all of them and a share
of a last one. The vector of these quotas is split among the output shards by a
binary tree: at each node the left half's share of every source is one
multivariate-hypergeometric draw. Then the shards draw, one after another and
each by its own generator, as many blocks of a source as the tree gave them from
those that no shard has drawn in that epoch. What the last draws are short of or beyond the
target is made up for at the end, where the last block is cut at the exact word.
Each shard is shuffled locally.

Sources smaller than a block have one block each, however many they are. The tree
sees them in pools by a hash, and a pool's draws are dealt to its shards by rank.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import WORD_PATTERN, from_driver, written
from tarmac.llm.merkle import ranked

#: Blocks of all sources together, shared by their sizes; also the number of pools of smaller sources.
BLOCKS = 1 << 14
#: Draws of pools are split in lots, of which there are about as many at most.
MOST_LOTS = 1 << 16
#: Words that an output shard holds, while there are enough blocks.
SHARD_WORDS = 1 << 22
MOST_REPEATS = 3
SEED = 17

_BLOCK_ROW = pa.schema([
    pa.field("_source_no", pa.int64(), False),
    pa.field("_block", pa.int32(), False),
    pa.field("_draws", pa.list_(pa.field("element", pa.struct([
        pa.field("epoch", pa.int32(), False),
        pa.field("shard", pa.int32(), False),
        pa.field("cut", pa.int64(), True),
    ]), False)), False),
])
_POOL_ROW = pa.schema([("_pool", pa.int32()), ("_runs", pa.list_(pa.struct([("end", pa.int64()), ("shard", pa.int32())])))])


@dataclass
class Share:
    """What one source of at least a block gets: its words, its target, and into how many blocks it is cut."""

    number: int
    words: int
    target: float
    blocks: int


def targets(sizes: list[int], weights: list[float], most: float = MOST_REPEATS) -> list[float]:
    """Share the sum of all sizes by weight; what exceeds ``most`` times a size is reshared until nothing does."""
    total, out = float(sum(sizes)), [0.0] * len(sizes)
    capped = [size == 0 for size in sizes]
    while not all(capped):
        left = total - sum(most * s for s, c in zip(sizes, capped, strict=True) if c)
        weight = sum(w for w, c in zip(weights, capped, strict=True) if not c)
        out = [float(most * s) if c else left * w / weight for s, w, c in zip(sizes, weights, capped, strict=True)]
        over = [not c and t > most * s for s, t, c in zip(sizes, out, capped, strict=True)]
        if not any(over):
            return out
        capped = [c or o for c, o in zip(capped, over, strict=True)]
    return [float(most * s) for s in sizes]


def shard_quotas(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, places, blocks) in the order of shards: how many blocks of which places of ``quotas`` each gets.

    Depth first, each node with the places that still have a quota, so that memory and time go by the blocks.
    """
    nodes = [(0, shards, np.flatnonzero(quotas), quotas[np.flatnonzero(quotas)])]
    while nodes:
        first, n, places, own = nodes.pop()
        if n == 1:
            yield first, places, own
            continue
        half = n // 2
        drawn = rng.multivariate_hypergeometric(own, int(own.sum()) * half // n, method="marginals") if len(own) else own
        rest = own - drawn
        nodes.append((first + half, n - half, places[rest > 0], rest[rest > 0]))
        nodes.append((first, half, places[drawn > 0], drawn[drawn > 0]))


def split_quotas(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """Blocks of each source (columns) that each shard (rows) gets; columns add up to the quotas, rows are even."""
    out = np.zeros((shards, len(quotas)), np.int64)
    for shard, places, own in shard_quotas(quotas, shards, rng):
        out[shard, places] = own
    return out


def _sized(docs: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    identity = F.col(doc_id).cast("string")
    return docs.withColumns({
        "_size": F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long"),
        "_place": F.xxhash64(identity, F.lit(SEED)),
        "_order": F.xxhash64(identity, F.lit(SEED + 1)),
        "_source": F.col(source).cast("string"),
    })


def _with_targets(sources: DataFrame) -> DataFrame:
    """Adds ``target`` to rows of (words, weight); the same shares as ``targets``, one small aggregate a round.

    A round finds the sources that the last level lifts above ``MOST_REPEATS`` times their words. Sums are of
    integers, so that their order does not matter.
    """
    total = sources.agg(F.sum("words")).first()[0] or 0
    most = F.col("words") * MOST_REPEATS
    share, capped, known = F.lit(0.0), F.col("words") == 0, -1
    while True:
        row = sources.agg(
            F.count_if(capped).alias("n"), F.sum(F.when(capped, most)).alias("full"), F.sum(F.when(~capped, F.col("weight"))).alias("weight"),
        ).first()
        if row["n"] == known or not row["weight"]:
            return sources.withColumn("target", F.when(capped, most.cast("double")).otherwise(share))
        known = row["n"]
        share = F.lit(float(total - (row["full"] or 0))) * F.col("weight") / F.lit(float(row["weight"]))
        capped = (F.col("words") == 0) | (share > most)


def source_table(sized: DataFrame) -> DataFrame:
    """One row per source, however many: number in code point order (null last), words, target, blocks, pool.

    Weights are 1, 2, 3, repeating. Sources of less than a block have a pool and the number of their draws.
    """
    rows = sized.groupBy("_source").agg(F.sum("_size").alias("words"))
    rows = rows.select("*", F.lit(0).alias("tree"), F.col("_source").isNull().alias("by_null"), F.col("_source").alias("by_name"))
    rows = ranked(rows, ["by_null", "by_name"]).select(
        F.col("_source").alias("_name"), F.col("rank").alias("_source_no"), "words", (F.col("rank") % 3 + 1).alias("weight")
    )
    rows = _with_targets(written(rows, "sources"))
    total = rows.agg(F.sum("words")).first()[0] or 0
    small = F.col("words") * BLOCKS < F.lit(total)
    blocks = F.greatest(F.lit(1), F.round(F.col("words") * (BLOCKS / max(1, total)))).cast("int")
    wanted = F.floor("target")
    return rows.select(
        "_name", "_source_no", F.col("words").alias("source_size"), "target",
        F.when(small, 1).otherwise(blocks).alias("_blocks"),
        F.when(small, F.pmod(F.xxhash64("_source_no", F.lit(SEED)), F.lit(BLOCKS)).cast("int")).alias("_pool"),
        F.when(small & (F.col("words") > 0), F.ceil(wanted / F.col("words"))).otherwise(0).cast("int").alias("_times"),
    )


def _with_shares(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """Adds a source's number, size, target and the row's block.

    No broadcast is asked for: Spark does so while the written table of sources is small, else adaptive execution splits a busy source.
    """
    joined = sized.join(sources, F.col("_source").eqNullSafe(F.col("_name"))).drop("_name")
    return joined.withColumn("_block", F.pmod("_place", F.col("_blocks")).cast("int")).drop("_blocks")


class _Blocks:
    """The blocks of one source: drawn without replacement within an epoch, then all again."""

    def __init__(self, share: Share, words: np.ndarray) -> None:
        self.share, self.words = share, words
        self.all = [int(b) for b in np.flatnonzero(words)]
        self.left: list[int] = []
        self.epoch = -1
        self.drawn: list[tuple[int, int, int]] = []  # block, epoch, shard
        self.wanted = int(share.target) if share.words else 0

    def quota(self) -> int:
        """Blocks in the target, by the mean of the source's blocks."""
        return -(-self.wanted * len(self.all) // self.share.words) if self.wanted else 0

    def draw(self, n: int, shard: int, rng: np.random.Generator) -> None:
        for _ in range(n):
            if not self.left:
                self.left, self.epoch = list(self.all), self.epoch + 1
            place = int(rng.integers(len(self.left)))
            self.left[place], self.left[-1] = self.left[-1], self.left[place]
            self.drawn.append((self.left.pop(), self.epoch, shard))

    def settle(self, rng: np.random.Generator) -> Iterator[tuple[int, int, int, int | None]]:
        """The draws up to the target, further ones by the last shard if they fall short: block, epoch, shard, cut."""
        before, at = 0, 0
        while before < self.wanted:
            if at == len(self.drawn):
                self.draw(1, self.drawn[-1][2] if self.drawn else 0, rng)
            block, epoch, shard = self.drawn[at]
            size, rest = int(self.words[block]), self.wanted - before
            yield block, epoch, shard, rest if rest < size else None
            before, at = before + size, at + 1


def _draw_plan(plan: list[Share], block_words: dict[int, np.ndarray], pools: dict[int, int], seed: int) -> tuple[list[tuple], list[tuple]]:
    """For every drawn block its list of (epoch, shard, cut), cut being null where all of it is taken; for every pool the lots of its shards."""
    sources = [_Blocks(share, block_words[share.number]) for share in plan]
    names = sorted(pools)
    quotas = np.array([s.quota() for s in sources] + [pools[p] for p in names], np.int64)
    wanted = sum(s.wanted for s in sources)
    shards = int(max(1, min(-(-wanted // SHARD_WORDS), quotas.sum())))
    runs: dict[int, list[tuple[int, int]]] = {p: [] for p in names}
    for shard, places, own in shard_quotas(quotas, shards, np.random.default_rng(seed)):
        for place, n in zip(places.tolist(), own.tolist(), strict=True):
            if place < len(sources):
                sources[place].draw(n, shard, np.random.default_rng([seed, shard, place]))
            else:
                run = runs[names[place - len(sources)]]
                run.append(((run[-1][0] if run else 0) + n, shard))
    out: dict[tuple[int, int], list] = {}
    for place, source in enumerate(sources):
        for block, epoch, shard, cut in source.settle(np.random.default_rng([seed, shards, place])):
            out.setdefault((source.share.number, block), []).append((epoch, shard, cut))
    return [(number, block, drawn) for (number, block), drawn in out.items()], list(runs.items())


def _pool_draws(sources: DataFrame) -> tuple[DataFrame, int, dict[int, int]]:
    """Each draw of a pooled source with its lot, the draws a lot holds, and the lots of each pool (at most ``BLOCKS`` rows)."""
    pooled = sources.filter("_times > 0")
    draws = pooled.agg(F.sum("_times")).first()[0] or 0
    lot = max(1, -(-draws // MOST_LOTS))
    order = Window.partitionBy("_pool").orderBy(F.xxhash64("_source_no", "epoch", F.lit(SEED + 2)), "_source_no", "epoch")
    each = pooled.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("_times") - 1)))
    each = each.withColumn("_lot", F.floor((F.row_number().over(order) - 1) / lot))
    lots = pooled.groupBy("_pool").agg(F.ceil(F.sum("_times") / lot).alias("lots")).collect() if draws else []
    return each, draws, {row["_pool"]: row["lots"] for row in lots}


def plan_mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sizes of all rows as a small written table, the table of sources, and the draws of every block of the larger ones.

    The driver gets a row per source of at least a block, per block and per pool: at
    most 4 * ``BLOCKS``, whatever the input's size and however many its sources.
    """
    sized = _sized(docs.select(doc_id, text, source), doc_id, text, source).drop(text, source)
    sized = written(sized, "sizes")
    sources = written(source_table(sized), "sources")
    large = sources.filter("_pool is null").orderBy("_source_no").collect()
    plan = [Share(r["_source_no"], r["source_size"], r["target"], r["_blocks"]) for r in large]
    block_words = {s.number: np.zeros(s.blocks, np.int64) for s in plan}
    blocks = _with_shares(sized, sources).filter("_pool is null").groupBy("_source_no", "_block")
    for row in blocks.agg(F.sum("_size").alias("words")).collect():
        block_words[row["_source_no"]][row["_block"]] = row["words"]
    each, draws, pools = _pool_draws(sources)
    drawn, runs = _draw_plan(plan, block_words, pools, seed)
    spark = sized.sparkSession
    if draws:
        rows = each.join(F.broadcast(from_driver(spark, runs, _POOL_ROW)), "_pool")  # at most BLOCKS pools, MOST_LOTS + BLOCKS runs
        shard = F.filter("_runs", lambda run: run["end"] > F.col("_lot"))[0]["shard"]
        rest = F.floor("target") - F.col("epoch") * F.col("source_size")
        cut = F.when(rest < F.col("source_size"), rest)
        one = F.struct(F.col("epoch").cast("int").alias("epoch"), shard.alias("shard"), cut.alias("cut"))
        small = rows.groupBy("_source_no").agg(F.array_sort(F.collect_list(one)).alias("_own_draws"))
        sources = written(sources.join(small, "_source_no", "left"), "sources-drawn")
    else:
        sources = sources.withColumn("_own_draws", F.lit(None).cast("array<struct<epoch:int,shard:int,cut:bigint>>"))
    return sized, sources, from_driver(spark, drawn, _BLOCK_ROW)


def _with_draws(rows: DataFrame, sources: DataFrame, drawn: DataFrame) -> DataFrame:
    """Adds ``_draws``: (epoch, shard, words) for each time a row is taken.

    The table of draws has at most 2 * ``BLOCKS`` rows and is broadcast.
    Only rows of cut blocks, one block per source, are put in order.
    """
    joined = _with_shares(rows, sources).join(F.broadcast(drawn), ["_source_no", "_block"], "left")
    joined = joined.withColumn("_draws", F.coalesce("_draws", "_own_draws")).drop("_own_draws", "_pool", "_times")
    joined = joined.withColumn("_cut", F.array_max(F.transform("_draws", lambda d: d["cut"])))
    running = Window.partitionBy("_source_no").orderBy("_order", "_place", "_size").rowsBetween(Window.unboundedPreceding, -1)
    cut = joined.filter("_cut is not null").withColumn("_before", F.coalesce(F.sum("_size").over(running), F.lit(0)))
    whole = joined.filter("_cut is null").withColumn("_before", F.lit(0).cast("long"))

    def words(d):
        part = F.least(F.col("_size"), F.greatest(F.lit(0).cast("long"), d["cut"] - F.col("_before")))
        return F.struct(d["epoch"].alias("epoch"), d["shard"].alias("shard"),
                        F.when(d["cut"].isNull(), F.col("_size")).otherwise(part).alias("words"))

    taken = F.filter(F.transform("_draws", words), lambda d: d["words"] > 0)
    empty = F.array().cast("array<struct<epoch:int,shard:int,words:bigint>>")
    return whole.unionByName(cut).withColumn("_draws", F.coalesce(taken, empty)).drop("_cut", "_before", "_block")


def mix_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED) -> DataFrame:
    """One row per document: id, size, source_size, target, taken (words the mix takes of it, repeats counted).

    A null text has size 0 and is never taken; a null source is a source of its
    own, the last. Rows that repeat an id stay together in a block and are taken
    as rows of their own. An empty table gives no rows. Another ``seed`` is another tree and so another draw.
    """
    sized, sources, drawn = plan_mix(docs, doc_id, text, source, seed)
    rows = _with_draws(sized, sources, drawn)
    taken = F.aggregate("_draws", F.lit(0).cast("long"), lambda total, d: total + d["words"])
    return rows.select(doc_id, F.col("_size").alias("size"), "source_size", "target", taken.alias("taken"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED) -> DataFrame:
    """The mix itself: the rows' own columns, once for each time a row is taken, plus mix_epoch and mix_shard.

    A document in which a source's target ends comes whole or not at all, whichever is nearer to the target.
    Rows of a shard stand together, in an order shuffled by a hash of id, epoch
    and shard. Reruns give the same rows in the same shards.
    """
    _, sources, drawn = plan_mix(docs, doc_id, text, source, seed)
    own = [c for c in docs.columns if c not in ("mix_epoch", "mix_shard")]
    held = docs.select(F.struct(*own).alias("_row"), F.col(doc_id).alias("_id"), F.col(text).alias("_text"), F.col(source).alias("_from"))
    rows = _with_draws(_sized(held, "_id", "_text", "_from"), sources, drawn)
    rows = rows.withColumn("_draw", F.explode("_draws")).filter(2 * F.col("_draw.words") >= F.col("_size"))
    out = rows.select(F.col("_row").alias("_out"), "_place", F.col("_draw.epoch").alias("mix_epoch"), F.col("_draw.shard").alias("mix_shard"))
    dealt = out.repartition("mix_shard").sortWithinPartitions("mix_shard", F.xxhash64("_place", "mix_epoch", "mix_shard"))
    return dealt.select("_out.*", "mix_epoch", "mix_shard")

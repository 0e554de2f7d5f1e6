"""Exact top-k inner products by block-at-a-time pruning.

Vectors become integers. Documents in id order are cut into blocks; a block
keeps its rows (forward index) and, per dimension, the largest and smallest
value. The sum over dimensions of the larger of q * max and q * min bounds
every score of a query in a block. Per query, blocks are visited from the
highest bound on and scored through their forward index until the bound falls
below the k-th score. Chunks of queries meet shelves of blocks, each pair a
task of bounded size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import written

BLOCK_ROWS = 256
SHELF_BLOCKS = 32
CHUNK_QUERIES = 2048


def _usable(embedding: str) -> Column:
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(embedding).isNotNull() & (F.size(embedding) > 0) & ~F.coalesce(bad, F.lit(True))


def _packed(rows: DataFrame, per_pack: int) -> DataFrame:
    """Consecutive rows of a partition and vector size as one: ids and an integer matrix, with its extremes."""

    def pack(size: int, held: list[tuple[int, list[int]]]) -> dict:
        matrix = np.array([v for _, v in held], np.int64)
        return {
            "size": size,
            "ids": np.array([i for i, _ in held], np.int64).tobytes(),
            "rows": matrix.tobytes(),
            "top": matrix.max(0).tobytes(),
            "low": matrix.min(0).tobytes(),
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[int, list[int]]]] = {}
        schema = pa.schema([("size", pa.int32()), *((c, pa.binary()) for c in ("ids", "rows", "top", "low"))])
        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = held.setdefault(len(v), [])
                own.append((i, v))
                if len(own) == per_pack:
                    yield pa.RecordBatch.from_pylist([pack(len(v), held.pop(len(v)))], schema)
        yield pa.RecordBatch.from_pylist([pack(size, own) for size, own in held.items()], schema)

    return rows.select("vec_id", "vector").mapInArrow(run, "size int, ids binary, rows binary, top binary, low binary")


def _numbered(packs: DataFrame, name: str, per_group: int) -> tuple[DataFrame, int]:
    """Packs with a running number of groups of ``per_group``; how many groups there are."""
    packs = written(packs.withColumn("at", F.monotonically_increasing_id()), name)
    # rank within a partition by the id's low bits, before it the packs of earlier partitions: one row per partition
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    counts = packs.groupBy(part.alias("part")).agg(((F.max(place) + per_group) / per_group).cast("int").alias("n")).orderBy("part").collect()
    first, firsts = 0, {}
    for row in counts:
        firsts[row.part] = first
        first += row.n
    starts = F.create_map(*[F.lit(x) for part_, n in firsts.items() for x in (part_, n)]) if firsts else None
    group = (starts[part] + (place / per_group).cast("int")).cast("int") if firsts else F.lit(0)
    return packs.withColumn("group", group).drop("at"), first


def _matrix(values: list[bytes], size: int) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.int64).reshape(-1, size)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products: in double precision where every sum stays below 2^53, else in 64-bit integers."""
    bound = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if bound < 2.0**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def search_shelf(queries: np.ndarray, query_ids: np.ndarray, blocks: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]],
                 k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The k best (id, score) of each query over blocks of (ids, rows, top, low), and how many blocks were scored.

    Returns query places, ids and scores; places with fewer than k candidates give fewer rows.
    """
    n = len(query_ids)
    tops, lows = np.stack([b[2] for b in blocks]), np.stack([b[3] for b in blocks])
    bounds = _products(np.maximum(queries, 0), tops) + _products(np.minimum(queries, 0), lows)
    order = np.argsort(-bounds, axis=1, kind="stable")
    # scores sort by value, ties by smaller id; free places hold the least value
    least = np.iinfo(np.int64).min
    best = np.full((n, k), least)
    ids = np.full((n, k), np.iinfo(np.int64).max)
    scored = 0
    live = np.arange(n)
    for step in range(len(blocks)):
        block = order[live, step]
        live = live[bounds[live, block] >= best[live, k - 1]]
        if not len(live):
            break
        block = order[live, step]
        for b in np.unique(block):
            who = live[block == b]
            block_ids, rows = blocks[b][0], blocks[b][1]
            scores = _products(queries[who], rows)
            scored += len(who)
            own = query_ids[who][:, None] == block_ids[None, :]
            every = np.concatenate([best[who], np.where(own, least, scores)], 1)
            every_ids = np.concatenate([ids[who], np.where(own, np.iinfo(np.int64).max, np.broadcast_to(block_ids, own.shape))], 1)
            first = np.lexsort((every_ids, ~every), axis=1)[:, :k]  # ~x is -x - 1, which can't overflow
            best[who] = np.take_along_axis(every, first, 1)
            ids[who] = np.take_along_axis(every_ids, first, 1)
    place, rank = np.nonzero(ids != np.iinfo(np.int64).max)
    return place, ids[place, rank], best[place, rank], scored


def _search(k: int):
    def run(key, chunk: pa.Table, shelf: pa.Table) -> pa.Table:
        size = chunk["size"][0].as_py() if len(chunk) else 0
        blocks = []
        for row in shelf.to_pylist():
            if row["size"] == size:
                ids = np.frombuffer(row["ids"], np.int64)
                blocks.append((ids, _matrix([row["rows"]], size), *(np.frombuffer(row[c], np.int64) for c in ("top", "low"))))
        if not len(chunk) or not blocks:
            return pa.table({c: pa.array([], pa.int64()) for c in ("query_id", "vec_id", "score")})
        query_ids = np.frombuffer(b"".join(chunk["ids"].to_pylist()), np.int64)
        queries = _matrix(chunk["rows"].to_pylist(), size)
        place, ids, scores, _ = search_shelf(queries, query_ids, blocks, k)
        return pa.table({"query_id": query_ids[place], "vec_id": ids, "score": scores})

    return run


def top_products(vectors: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding",
                 scale: float = 256.0) -> DataFrame:
    """Rows query_id, rank, vec_id, score: each query's k largest inner products of floor(scale * x), ties to the smaller id.

    ``is_query`` picks the query rows. Every row but those with the query's own
    id is a candidate. Null or empty vectors, vectors that hold null or
    non-finite components, and rows with a null id take no part; only vectors of
    equal length are compared. Where an id repeats, each row is a candidate, and
    the query is the smallest of its vectors. Integers are exact while products stay within 64 bits.
    A query without candidates gives no row.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("e"), is_query.alias("asks"))
    rows = rows.filter(F.col("vec_id").isNotNull() & _usable("e")).select(
        "vec_id", "asks", F.transform("e", lambda x: F.floor(x * F.lit(scale)).cast("long")).alias("vector")
    )
    rows = written(rows, "vectors")
    asking = rows.filter("asks").groupBy("vec_id").agg(F.min("vector").alias("vector"))
    asking = written(asking, "queries")
    asking = asking.repartition(max(1, math.ceil(asking.count() / CHUNK_QUERIES)))
    chunks, n_chunks = _numbered(_packed(asking, CHUNK_QUERIES), "chunks", 1)
    shelves_wanted = max(1, math.ceil(rows.count() / (BLOCK_ROWS * SHELF_BLOCKS)))
    ranged = rows.repartitionByRange(shelves_wanted, "vec_id", F.xxhash64("vector")).sortWithinPartitions("vec_id")
    shelves, n_shelves = _numbered(_packed(ranged, BLOCK_ROWS), "shelves", SHELF_BLOCKS)
    width = F.lit(max(1, n_shelves)).cast("long")
    asked = chunks.withColumn("shelf", F.explode(F.sequence(F.lit(0), F.lit(max(0, n_shelves - 1)))))
    met = shelves.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(max(0, n_chunks - 1)))))
    asked = asked.withColumn("meeting", F.col("group") * width + F.col("shelf"))
    met = met.withColumn("meeting", F.col("chunk") * width + F.col("group"))
    found = (
        asked.select("meeting", "size", "ids", "rows")
        .groupBy("meeting")
        .cogroup(met.select("meeting", "size", "ids", "rows", "top", "low").groupBy("meeting"))
        .applyInArrow(_search(k), "query_id long, vec_id long, score long")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

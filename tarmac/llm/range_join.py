"""Exact similarity join of embeddings as a metric range join.

Cosine >= c between unit vectors is Euclidean distance <= r = sqrt(2 - 2c).
Pivots cut each label's vectors into cells (nearest pivot). By the triangle
inequality a vector y can only be within r of a vector at home in the cell of
pivot p if d(y, p) <= d(y, home pivot) + 2r and d(y, p) <= radius of that cell + r;
it is replicated to just those cells. Cells then join independently: a vector's
links are counted in its home cell against all that is there. A large cell is
cut into blocks whose pairs are separate tasks, so no cell has to fit in one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import written
from tarmac.llm.components import connected_components

ROWS_PER_PIVOT = 8192
MOST_PIVOTS = 1024
BLOCK_ROWS = 2048


def _unit_vectors(column: pa.Array) -> list[bytes | None]:
    """Unit vectors in double precision; None for null, empty, zero, null-holding or non-finite ones."""
    out: list[bytes | None] = []
    for value in column:
        x = value.values if value.is_valid else None
        if x is None or not len(x) or x.null_count:
            out.append(None)
            continue
        v = x.to_numpy(zero_copy_only=False).astype(np.float64)
        top = np.abs(v).max()
        if not np.isfinite(top) or top == 0:
            out.append(None)
            continue
        v = v / top
        out.append((v / np.sqrt(v @ v) + 0.0).tobytes())  # + 0.0: no negative zeros, so equal vectors have equal bytes
    return out


def _prepared(vectors: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = pa.array(_unit_vectors(batch.column(2)), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), units], ["vec_id", "label", "unit"])

    kind = vectors.schema[label].dataType.simpleString()
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(embedding))
    prepared = rows.mapInArrow(run, f"vec_id long, label {kind}, unit binary")
    usable = F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    return prepared.withColumn("unit", F.when(usable, F.col("unit")))


def _pivots(classes: DataFrame, rows: int) -> dict[int, np.ndarray]:
    """Pivots by vector size in bytes: a sample of at most ``MOST_PIVOTS`` vectors in hash order."""
    wanted = min(MOST_PIVOTS, max(2, math.ceil(rows / ROWS_PER_PIVOT)))
    chosen = classes.select("unit", F.xxhash64("unit").alias("h")).distinct().orderBy("h").limit(wanted).collect()
    by_size: dict[int, list[np.ndarray]] = {}
    for row in chosen:
        by_size.setdefault(len(row.unit), []).append(np.frombuffer(row.unit))
    return {size: np.stack(units) for size, units in by_size.items()}


def _home_cells(classes: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Adds the nearest pivot and the distance to it; vectors of a size without pivots share cell 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, distances = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows)
            for k, unit in enumerate(batch.column("unit").to_pylist()):
                if (own := pivots.get(len(unit))) is not None:
                    gap = np.linalg.norm(own - np.frombuffer(unit), axis=1)
                    cells[k] = gap.argmin()
                    distances[k] = gap[cells[k]]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells), pa.array(distances)], [*batch.schema.names, "cell", "gap"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema)
    return classes.mapInArrow(run, f"{fields}, cell int, gap double")


def _replicas(homes: DataFrame, pivots: dict[int, np.ndarray], radii: dict[tuple[int, int], float], r: float) -> DataFrame:
    """Copies of vectors for the other cells in which something may lie within r of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, cells = [], []
            for k, (unit, home, gap) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("unit", "cell", "gap")), strict=True)):
                if (own := pivots.get(len(unit))) is not None:
                    away = np.linalg.norm(own - np.frombuffer(unit), axis=1)
                    reach = np.array([radii.get((len(unit), c), -1.0) for c in range(len(own))])
                    near = (away <= gap + 2 * r) & (away <= reach + r) & (reach >= 0)
                    near[home] = False
                    found = np.flatnonzero(near)
                    rows += [k] * len(found)
                    cells += found.tolist()
            copies = batch.take(pa.array(rows, pa.int64()))
            copies = copies.set_column(batch.schema.get_field_index("cell"), "cell", pa.array(cells, pa.int32()))
            yield copies

    return homes.mapInArrow(run, homes.schema)


def _forest(linked: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Links that span every component of a bipartite block, at most one per member."""
    rows, columns = linked.any(1), np.zeros(linked.shape[1], bool)
    out = []
    for start in np.flatnonzero(rows):
        if not rows[start]:
            continue
        rows[start] = False
        front = np.array([start])
        while len(front):
            reached = linked[front].any(0) & ~columns
            columns |= reached
            new = np.flatnonzero(reached)
            if not len(new):
                break
            out += [(int(left[start]), int(right[k])) for k in new]
            back = linked[:, new].any(1) & rows
            rows &= ~back
            front = np.flatnonzero(back)
            out += [(int(left[start]), int(left[k])) for k in front]
    return out


def _join_block(threshold: float):
    """Compares one pair of blocks; gives (node, links) of the rows at home and, with a null node, links that span it."""

    def run(group: pa.Table) -> pa.Table:
        node, rep = group["node"].to_numpy(), group["rep"].to_numpy()
        copies, on_left = group["copies"].to_numpy(), group["on_left"].to_numpy(zero_copy_only=False)
        home = group["home"].to_numpy(zero_copy_only=False)
        unit = np.frombuffer(b"".join(group["unit"].to_pylist())).reshape(len(node), -1)
        a = np.flatnonzero(on_left)
        same = not (~on_left).any()
        b = a if same else np.flatnonzero(~on_left)
        linked = unit[a] @ unit[b].T >= threshold
        linked &= node[a][:, None] != node[b][None, :]
        nodes, counts = [node[a]], [linked @ copies[b]]
        if not same and home[b].all():
            nodes.append(node[b])
            counts.append(copies[a] @ linked)
        nodes, counts = np.concatenate(nodes), np.concatenate(counts)
        found = counts > 0
        links = _forest(linked, rep[a], rep[b])
        pad = [None] * len(links)
        return pa.table({
            "node": pa.array([*nodes[found].tolist(), *pad], pa.int64()),
            "links": pa.array([*counts[found].tolist(), *pad], pa.int64()),
            "a": pa.array([*[None] * int(found.sum()), *(x for x, _ in links)], pa.int64()),
            "b": pa.array([*[None] * int(found.sum()), *(x for _, x in links)], pa.int64()),
        })

    return run


def _block_pairs(homes: DataFrame, replicas: DataFrame) -> DataFrame:
    """One row per vector and block pair it takes part in. ``pair`` (i, j) is of home blocks, j < 0 one of replicas."""
    key = ["label", "size", "cell"]
    both = homes.withColumn("home", F.lit(True)).unionByName(replicas.withColumn("home", F.lit(False))).drop("gap")
    both = both.withColumn("size", F.length("unit"))
    per_cell = both.groupBy(*key).agg(
        F.ceil(F.count_if("home") / BLOCK_ROWS).cast("int").alias("blocks"),
        F.ceil(F.count_if(~F.col("home")) / BLOCK_ROWS).cast("int").alias("guests"),
    )
    rows = both.join(per_cell, key).filter("blocks > 0")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node", "unit"), F.when(F.col("home"), F.col("blocks")).otherwise(F.col("guests"))).cast("int"))

    def pairs(first, second, on_left):
        return F.struct(first.cast("int").alias("i"), second.cast("int").alias("j"), F.lit(on_left).alias("on_left"))

    own = F.col("own")
    none = F.array().cast("array<struct<i:int,j:int,on_left:boolean>>")
    as_home = F.concat(
        F.transform(F.sequence(own, F.col("blocks") - 1), lambda j: pairs(own, j, True)),
        F.when(own > 0, F.transform(F.sequence(F.lit(0), own - 1), lambda i: pairs(i, own, False))).otherwise(none),
        F.when(F.col("guests") > 0, F.transform(F.sequence(F.lit(1), F.col("guests")), lambda j: pairs(own, -j, True))).otherwise(none),
    )
    as_guest = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda i: pairs(i, -own - 1, False))
    return rows.withColumn("pair", F.explode(F.when(F.col("home"), as_home).otherwise(as_guest))).select(
        *key, "pair.i", "pair.j", "pair.on_left", "home", "node", "rep", "copies", "unit"
    )


def link_similar(vectors: DataFrame, threshold: float = 0.98, vec_id: str = "vec_id", embedding: str = "embedding",
                 label: str = "label") -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors of the same non-null label and length link when their cosine in
    double precision reaches the threshold. Equal directions are joined once and
    counted by their copies. Null, empty, zero, null-holding or non-finite
    vectors, and rows without an id or a label, link with nothing and are kept;
    a row without an id has a null component. Rows that repeat an id are vectors
    of their own that share a component. Other columns are not carried.
    """
    r = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-9
    prepared = written(_prepared(vectors, vec_id, embedding, label), "vectors")
    classes = prepared.filter("unit is not null").groupBy("label", "unit").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")
    )
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    pivots = _pivots(classes, classes.count())
    homes = written(_home_cells(classes, pivots), "homes")
    # at most MOST_PIVOTS rows reach the driver
    radii = {(x.size, x.cell): x.reach for x in homes.groupBy(F.length("unit").alias("size"), "cell").agg(F.max("gap").alias("reach")).collect()}
    pairs = _block_pairs(homes, _replicas(homes, pivots, radii, r))
    joined = pairs.groupBy("label", "size", "cell", "i", "j").applyInArrow(
        _join_block(threshold), "node long, links long, a long, b long"
    )
    joined = written(joined, "joined")
    links = joined.filter("node is not null").groupBy("node").agg(F.sum("links").alias("links"))
    components = connected_components(joined.filter("node is null").select("a", "b"))
    members = classes.join(links, "node", "left").join(
        components.select(F.col("node").alias("rep"), "component"), "rep", "left"
    ).select("label", "unit", "rep", "copies", "links", "component")
    out = prepared.join(members, ["label", "unit"], "left")
    component = F.coalesce("component", "rep", "vec_id")
    return out.select(
        "vec_id",
        (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )

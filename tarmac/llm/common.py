"""What several operators share: shared tables, bounded samples and byte-level work on Arrow text columns."""

from __future__ import annotations

import contextlib
import ctypes
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarmac.sources.tables import fresh_folder

#: `[^\x20\x09-\x0D]+` in Java and Python syntax: a word is a run of other characters.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

SLICE_BYTES = 1 << 20
BATCH_ROWS_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1000

#: Hint for joins of intermediate tables in operators of many steps: none of them is collected and held by the
#: driver, whose broadcasts would add up over the steps. Adaptive execution still splits skewed partitions.
JOIN = "merge"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared folder and read back; cuts the lineage for good."""
    path = fresh_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def from_driver(spark: SparkSession, rows: list[tuple], schema: pa.Schema) -> DataFrame:
    """A table of rows made on the driver, handed over in Arrow's form.

    Spark would read rows of Python objects with Python workers of another kind than those of Arrow
    functions; an executor keeps both kinds, and their memory adds up.
    """
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return spark.createDataFrame(pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema))


def fold(doc_id: str, parts: int) -> Column:
    """crc32 of an id's decimal text, modulo the number of folds; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string")) % parts


def per_process(key: str, make: Callable):
    """A value built once per Python worker, whichever task asks for it first."""
    store = sys.modules.setdefault("_worker_values", types.ModuleType("_worker_values"))
    if not hasattr(store, key):
        setattr(store, key, make())
    return getattr(store, key)


class Remembered:
    """Values of keys met lately, in two generations: a full younger one becomes the older one."""

    def __init__(self, most: int) -> None:
        self.most = most
        self.young: dict = {}
        self.old: dict = {}

    def learn(self, keys: set, make: Callable[[list], list]) -> dict:
        """A table that knows all these keys; ``make`` gives the values of those not remembered."""
        missing = list(keys.difference(self.young))
        if len(self.young) + len(missing) > self.most:
            self.old, self.young = self.young, {}
            missing = list(keys)
        new = []
        for key in missing:
            found = self.old.get(key)
            if found is None:
                new.append(key)
            else:
                self.young[key] = found
        self.young.update(zip(new, make(new), strict=True))
        return self.young


def gathered(lists: pa.ListArray, remembered: Remembered, make: Callable[[list], list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of lists of keys, one list after the other, and how many each list has.

    A key stands for the ids that ``make`` gives as little-endian unsigned 32-bit integers. Arrow numbers
    the distinct keys; only those are looked up, and numpy gathers their ids.
    """
    numbered = lists.flatten().dictionary_encode()
    keys = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
    known = remembered.learn(set(keys), make)
    parts = list(map(known.__getitem__, keys))
    lengths = np.fromiter(map(len, parts), np.int64, len(parts)) >> 2
    ids, begins = np.frombuffer(b"".join(parts), "<u4"), np.cumsum(lengths) - lengths
    codes = numbered.indices.to_numpy()
    n = lengths[codes]
    ends = np.append(0, np.cumsum(n))
    place = np.repeat(begins[codes] - ends[:-1], n)
    place += np.arange(ends[-1])
    return ids[place], np.diff(ends[lists.offsets.to_numpy()])


def free_name(columns: list[str], base: str) -> str:
    """``base``, with underscores before it until no column has that name in any case."""
    taken = {c.lower() for c in columns}
    while base.lower() in taken:
        base = "_" + base
    return base


def bounded_sample(keys: DataFrame, docs: DataFrame, doc_id: str, text: str, max_rows: int, max_bytes: int) -> list:
    """Texts of a sample of each stratum, the same ones on each run, as rows of id, stratum, all of ``docs``.

    ``keys`` has the columns id and stratum, of which there are few kinds. Only documents with any text but blanks
    are considered. Of each stratum the first ``max_rows`` ids in the order of a hash are taken, with one
    row each (the one of the smallest text where an id repeats), and of these as many as come to ``max_bytes`` UTF-8 bytes.
    Of a text above a hundredth of it a piece from its middle is learned. Each task
    keeps no more than ``max_rows`` ids of a stratum before they meet; texts are read where they lie.
    """
    usable = docs.filter(F.col(text).rlike(r"[^\x20\x09-\x0D]")).select(F.col(doc_id).alias("_id")).distinct()
    keyed = keys.select(F.col("id"), F.col("stratum"), F.xxhash64(F.col("id").cast("string"), F.lit(11)).alias("_order"))
    keyed = keyed.join(usable, F.col("id") == F.col("_id"), "left_semi")
    firsts = [
        keyed.filter(F.col("stratum") == row["stratum"]).orderBy("_order", "id").limit(max_rows)
        for row in keys.select("stratum").distinct().orderBy("stratum").collect()
    ]
    if not firsts:
        return []
    chosen = firsts[0]
    for more in firsts[1:]:
        chosen = chosen.unionByName(more)
    rows = docs.filter(F.col(text).rlike(r"[^\x20\x09-\x0D]")).join(F.broadcast(chosen), docs[doc_id] == F.col("id"))
    most, length, size = max_bytes // 100, F.length(text), F.octet_length(text)
    kept = F.floor(length * (most / size)).cast("int")
    middle = F.substring(F.col(text), (F.floor((length - kept) / 2) + 1).cast("int"), kept)
    rows = rows.withColumn(text, F.when(size <= most, F.col(text)).otherwise(middle))
    one = rows.groupBy("id", "stratum", "_order").agg(F.min(F.struct(text, *[c for c in docs.columns if c != text])).alias("_row"))
    rows = one.select("id", "stratum", "_order", "_row.*").withColumn("_bytes", F.octet_length(text))
    running = Window.partitionBy("stratum").orderBy("_order", "id").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_total", F.sum("_bytes").over(running)).filter(F.col("_total") <= max_bytes)
    return rows.orderBy("_order", "stratum", text).collect()


def label_keys(labels: DataFrame, doc_id: str, label: str) -> DataFrame:
    """(id, stratum) of the rows labelled 0 or 1; where an id repeats, its smallest label."""
    rows = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("stratum"))
    return rows.filter("id is not null and stratum in (0, 1)").groupBy("id").agg(F.min("stratum").alias("stratum"))


def byte_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and the offsets of its rows; a null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data, offsets


#: Logarithm of the most bits that a filter may have: 16 MB, however many keys there are.
FILTER_BITS = 27


def bit_filter(keys: DataFrame, n: int, bits_per_key: int = 16, slices_of_key: int = 1, most_bits: int = FILTER_BITS) -> tuple:
    """A broadcast bit field in which the bits of ``n`` well-mixed 64-bit keys (column ``key``) are set, for ``passing``.

    A key sets one bit for each of its slices from the lowest bits up. The field has ``bits_per_key`` bits
    a key, but 2^most_bits at most, which bounds what the driver holds. Beyond that more other keys pass.
    """
    bits = min(max((bits_per_key * n).bit_length(), 16), most_bits)
    parts = [F.shiftrightunsigned("key", bits * i).bitwiseAND((1 << bits) - 1) for i in range(slices_of_key)]
    places = keys.select(F.explode(F.array(*parts)).alias("place"))
    flag = F.expr("shiftleft(1L, cast(place & 63 as int))")
    cells = places.groupBy(F.shiftright("place", 6).alias("cell")).agg(F.bit_or(flag).alias("flags")).toArrow()
    field = np.zeros(1 << (bits - 6), np.uint64)
    field[cells.column("cell").to_numpy()] = cells.column("flags").to_numpy().view(np.uint64)
    return keys.sparkSession.sparkContext.broadcast(field.tobytes()), bits, slices_of_key


def passing(keyed_bits: tuple, keys: np.ndarray) -> np.ndarray:
    """Which keys may be in a filter; those that are in it always pass."""
    field, bits, slices_of_key = np.frombuffer(keyed_bits[0].value, np.uint64), keyed_bits[1], keyed_bits[2]
    found = np.ones(len(keys), bool)
    for i in range(slices_of_key):
        place = (keys >> np.uint64(bits * i)) & np.uint64((1 << bits) - 1)
        found &= (field[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1
    return found


def hand_back() -> None:
    """Return freed memory to the system: Python workers live on after a task, the driver after a training."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def with_columns_from_text(
    docs: DataFrame, text: str, added: dict[str, str], run: Callable[[pa.Array], list[pa.Array]], limit: int = 4 * SLICE_BYTES
) -> DataFrame:
    """The other columns as they are, and those that ``run`` makes of the text column, about ``limit`` bytes at a time."""
    rest = [c for c in docs.columns if c != text and c not in added]
    fields = ", ".join(
        [*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in rest), *(f"{c} {kind}" for c, kind in added.items())]
    )

    def on_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            texts = whole.column(whole.num_columns - 1)
            ranges = slices(byte_buffers(texts)[1], limit) if pa.types.is_string(texts.type) else [(0, len(texts))]
            for first, last in ranges:
                batch = whole.slice(first, last - first)
                columns = [*batch.columns[:-1], *run(batch.column(batch.num_columns - 1))]
                yield pa.RecordBatch.from_arrays(columns, [*rest, *added])
        hand_back()

    # texts are long: the usual 10,000 rows would make batches of tens of megabytes in either process
    if int(docs.sparkSession.conf.get(BATCH_ROWS_KEY)) > BATCH_ROWS:
        docs.sparkSession.conf.set(BATCH_ROWS_KEY, str(BATCH_ROWS))

    return docs.select(*(docs[c] for c in rest), docs[text]).mapInArrow(on_batches, fields)


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``limit`` bytes; a longer row comes alone."""
    rows, first = len(offsets) - 1, 0
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def separators(alphanumeric: bool = False) -> np.ndarray:
    """Which of the 256 bytes part words: blanks, or with ``alphanumeric`` every ASCII byte but letters and digits."""
    table_ = np.zeros(256, bool)
    table_[[9, 10, 11, 12, 13, 32]] = True
    if alphanumeric:
        table_[:128] = True
        for first, last in ((48, 57), (65, 90), (97, 122)):
            table_[first : last + 1] = False
    return table_


def word_hashes(data: np.ndarray, offsets: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words, ASCII letters folded to lower case, and the number of words of each row."""
    lo, hi = int(offsets[0]), int(offsets[-1])
    data, ends = data[lo:hi], offsets - lo
    rows = len(offsets) - 1
    inside = ~parts[data]
    if not inside.any():
        return np.zeros(0, np.uint64), np.zeros(rows, np.int64)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = ends[:-1][ends[:-1] < len(data)]
    begins[heads] = inside[heads]
    starts = np.flatnonzero(begins)
    place = np.flatnonzero(inside)
    chars = data[place].astype(np.uint64)
    chars += np.uint64(32) * ((chars >= 65) & (chars <= 90))
    first = np.searchsorted(place, starts)
    lengths = np.diff(np.append(first, len(place)))
    within = np.arange(len(place)) - np.repeat(first, lengths)
    powers = np.cumprod(np.full(int(lengths.max()), 0x9E3779B97F4A7C15, np.uint64))
    hashes = mixed(np.add.reduceat((chars + np.uint64(1)) * powers[within], first))
    return hashes, np.diff(np.searchsorted(starts, ends))

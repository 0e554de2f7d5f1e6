"""Near-duplicates of documents by ProbMinHash.

A document is a weighted set of five-word shingles. Each shingle's exponential
arrivals, at a rate of its weight, fall on the slots of a signature; a slot keeps
the shingle that arrives first, and a shingle stops once its next arrival comes
after every slot's. Two signatures agree in a slot with the probability Jaccard
similarity of their weighted sets. Bands of slots give candidate buckets.
Candidates are verified by the exact Jaccard similarity of their shingles. As that
does not count repeats, a document has bands of equal weights, which estimate it,
and beside them, where it repeats a shingle, bands of weights 1 + ln(times).

Buckets are not expanded into pairs. In each round, every bucket is compared with
one centre, the member that shares most buckets with others; verified links are
joined into classes. Documents of buckets that still hold several classes after
the rounds, such as those that share a passage without being alike, are compared
where their rarest shingles allow the similarity (prefix and position bounds), so
no similar candidate pair is left out and unlike ones are not listed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.llm.common import JOIN, byte_buffers, mixed, separators, slices, with_columns_from_text, word_hashes, written
from tarmac.llm.components import connected_components

WORDS = 5
THRESHOLD = 0.8
BANDS = 32
ROWS = 6
SLOTS = BANDS * ROWS
ROUNDS = 2
BLANKS = separators()
_SALTS = mixed(np.arange(1, 9, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def shingles(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the shingles of every row in text order, and how many each row has.

    A row of fewer words has one shingle of all its words; a row without words has none.
    """
    hashes, counts = word_hashes(data, offsets, BLANKS)
    if not len(hashes):
        return hashes, counts
    padded = np.append(hashes, np.zeros(words - 1, np.uint64))
    total = np.zeros(len(hashes), np.uint64)
    place = np.arange(len(hashes)) - np.repeat(np.cumsum(counts) - counts, counts)
    size = np.repeat(counts, counts)
    for k in range(words):
        total = total * np.uint64(0xD6E8FEB86659FD93) + np.where(place + k < size, padded[k : k + len(hashes)], np.uint64(0))
    kept = place <= np.maximum(size - words, 0)
    return mixed(total)[kept], np.where(counts == 0, 0, np.maximum(counts - words + 1, 1))


def weighted_sets(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of every row in rising order, how often each occurs, and how many each row has."""
    row = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((values, row))
    values, row = values[order], row[order]
    first = np.append(True, (values[1:] != values[:-1]) | (row[1:] != row[:-1])) if len(values) else np.zeros(0, bool)
    starts = np.flatnonzero(first)
    times = np.diff(np.append(starts, len(values)))
    return values[starts], times, np.bincount(row[starts], minlength=len(counts))


def _uniform(values: np.ndarray, salt: int, arrival: int) -> np.ndarray:
    """Hashes that differ by arrival and salt."""
    return mixed(values ^ (_SALTS[salt : salt + 1] * np.uint64(2 * arrival + 1)))


def signatures(values: np.ndarray, weights: np.ndarray, counts: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """ProbMinHash signatures: for each row and slot the shingle that arrives first (rows without shingles: 0)."""
    rows = len(counts)
    first = np.full(rows * slots, np.inf)
    kept = np.zeros(rows * slots, np.uint64)
    row = np.repeat(np.arange(rows), counts)
    live, time, arrival = np.arange(len(values)), np.zeros(len(values)), 0
    while len(live):
        own = values[live]
        step = (_uniform(own, 0, arrival) >> np.uint64(11)).astype(np.float64) * 2.0**-53
        time = time - np.log1p(-step) / weights[live]
        place = row[live] * slots + (_uniform(own, 1, arrival) % np.uint64(slots)).astype(np.int64)
        np.minimum.at(first, place, time)
        wins = time == first[place]
        kept[place[wins]] = own[wins]
        latest = first.reshape(rows, slots).max(1)
        going = time < latest[row[live]]
        live, time, arrival = live[going], time[going], arrival + 1
    return kept.reshape(rows, slots)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, different bands apart."""
    bands = signature.reshape(len(signature), BANDS, ROWS)
    key = np.broadcast_to(mixed(np.arange(1, BANDS + 1, dtype=np.uint64)), bands.shape[:2]).copy()
    for k in range(ROWS):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + bands[:, :, k])
    return key.view(np.int64)


def _fingerprints(values: np.ndarray, times: np.ndarray, counts: np.ndarray) -> list[bytes | None]:
    """128 bits of each row's weighted set; None for rows without shingles."""
    if not len(values):
        return [None] * len(counts)
    some = counts > 0
    starts = (np.cumsum(counts) - counts)[some]
    out: list[bytes | None] = [None] * len(counts)
    both = [np.add.reduceat(mixed(mixed(values ^ _SALTS[k]) + times.astype(np.uint64)), starts) for k in (4, 5)]
    for at, a, b in zip(np.flatnonzero(some), *both, strict=True):
        out[at] = a.tobytes() + b.tobytes()
    return out


def _all_band_keys(values: np.ndarray, times: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Band keys of all rows, one row after the other, and how many each row has.

    Those of equal weights, and those of the repeats' weights where they differ;
    a row without repeats has the same of both.
    """
    row = np.repeat(np.arange(len(counts)), counts)
    often = np.bincount(row[times > 1], minlength=len(counts)) > 0
    plain = band_keys(signatures(values, np.ones(len(values)), counts))
    keys, kept = np.concatenate([plain, plain], 1), np.zeros((len(counts), 2 * BANDS), bool)
    kept[:, :BANDS] = True
    own = often[row]
    keys[often, BANDS:] = band_keys(signatures(values[own], 1.0 + np.log(times[own]), counts[often]))
    kept[often, BANDS:] = keys[often, BANDS:] != plain[often]
    return keys[kept], kept.sum(1)


def _signed(docs: DataFrame, words: int) -> DataFrame:
    """Adds ``print`` and ``keys`` in place of the text."""

    def run(column: pa.Array) -> list[pa.Array]:
        data, offsets = byte_buffers(column)
        prints: list[bytes | None] = []
        keys, sizes = [np.zeros(0, np.int64)], [np.zeros(1, np.int64)]
        for a, b in slices(offsets):
            values, times, counts = weighted_sets(*shingles(data, offsets[a : b + 1], words))
            prints += _fingerprints(values, times, counts)
            for made, of in zip(_all_band_keys(values, times, counts), (keys, sizes), strict=True):
                of.append(made)
        ends = np.cumsum(np.concatenate(sizes)).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(keys)))
        return [pa.array(prints, pa.binary()), lists]

    return with_columns_from_text(docs, "text", {"print": "binary", "keys": "array<bigint>"}, run)


def _shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """Adds ``shingles`` in place of the text: the distinct ones, rising, as 64-bit integers."""

    def run(column: pa.Array) -> list[pa.Array]:
        data, offsets = byte_buffers(column)
        out = []
        for a, b in slices(offsets):
            values, _, counts = weighted_sets(*shingles(data, offsets[a : b + 1], words))
            out += [x.tobytes() for x in np.split(values, np.cumsum(counts)[:-1])]
        return [pa.array(out, pa.binary())]

    return with_columns_from_text(docs, "text", {"shingles": "binary"}, run)


def jaccard(a: bytes, b: bytes) -> float:
    """Jaccard similarity of two sets of rising 64-bit integers."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if not len(x) or not len(y):
        return 0.0
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    common = int((y[at] == x).sum())
    return common / (len(x) + len(y) - common)


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose similarity reaches the threshold. A much-used b is split by adaptive execution."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            similar = [jaccard(x.as_buffer(), y.as_buffer()) >= threshold for x, y in zip(batch.column(2), batch.column(3), strict=True)]
            yield batch.select([0, 1]).filter(pa.array(similar, pa.bool_()))

    left = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("of_b"))
    joined = pairs.join(left.hint(JOIN), "a").join(right.hint(JOIN), "b").select("a", "b", "of_a", "of_b")
    return joined.mapInArrow(run, "a long, b long")


def _ranked_shingles(reps: DataFrame, sets: DataFrame) -> DataFrame:
    """Rows (rep, component, size, shingle, at): each set's shingles, ``at`` counting from the rarest among all sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rep, component = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            for k, x in enumerate(batch.column(2)):
                own = np.frombuffer(x.as_buffer(), np.int64)
                same = (np.full(len(own), v, np.int64) for v in (rep[k], component[k], len(own)))
                yield pa.RecordBatch.from_arrays([*(pa.array(v) for v in same), pa.array(own)], ["rep", "component", "size", "shingle"])

    chosen = sets.join(reps.hint(JOIN), "rep").select("rep", "component", "shingles")
    rows = written(chosen.mapInArrow(run, "rep long, component long, size long, shingle long"), "leftover")
    often = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("holders"))
    rank = F.row_number().over(Window.partitionBy("rep").orderBy("holders", "shingle"))
    return rows.join(often.hint(JOIN), "shingle").withColumn("at", rank)


def _possible_pairs(reps: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of different components that can reach the threshold, every such pair that does among them.

    Two sets of that similarity share a shingle among the rarest of each, and from
    the first shared one on, both have enough shingles left for the overlap it takes.
    """
    prefix = F.col("size") - F.ceil(F.col("size") * threshold - 1e-9) + 1
    front = _ranked_shingles(reps, sets).filter((F.col("at") <= prefix) & (F.col("holders") > 1))
    front = written(front.select("rep", "component", "size", "shingle", "at"), "front")
    several = front.groupBy("shingle").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi")
    front = front.join(several.select("shingle").hint(JOIN), "shingle")
    a, b = (front.select("shingle", *(F.col(c).alias(f"{c}_{side}") for c in ("rep", "component", "size", "at"))) for side in "ab")
    overlap = F.least(F.col("size_a") - F.col("at_a"), F.col("size_b") - F.col("at_b")) + 1
    enough = overlap * (1 + threshold) >= (F.col("size_a") + F.col("size_b")) * threshold - 1e-9
    apart = (F.col("component_a") != F.col("component_b")) & (F.col("rep_a") < F.col("rep_b"))
    return a.join(b.hint(JOIN), "shingle").filter(apart & enough).select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b"))


def mark(text: str = "text") -> Column:
    """Tells apart the texts of rows that share an id: a 64-bit hash."""
    return F.xxhash64(text)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, class_id, kept.

    Documents link when the Jaccard similarity of their distinct shingles of
    whitespace-separated words (ASCII case folded) is at least ``threshold``;
    classes are what links connect, ``class_id`` is the smallest id in it, and a
    document of that id is kept. Documents with the same shingles, as often, are
    one class from the start. Null, empty and wordless texts link with nothing.
    A text of fewer words than a shingle has one shingle. Rows with a null id are
    kept, in no class. Rows that repeat an id are documents of their own: their
    texts are compared like any others, so unlike ones may be kept in two classes
    of the same ``class_id``, and of like ones one is kept. Rows that repeat both
    id and text share ``kept``.
    """
    return row_classes(docs, doc_id, text, words, threshold).select("doc_id", "class_id", "kept")


def row_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``near_duplicates`` with the ``mark`` of each text. An id and a mark name the rows of one text.

    Sets of shingles, not ids, are the nodes that links connect; 64 bits of their fingerprints name them.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), mark(text).alias("mark"), F.col(text).alias("text"))
    signed = written(_signed(rows, words), "signed")
    usable = signed.filter("print is not null and doc_id is not null")
    row = F.struct("doc_id", "mark")
    bands = usable.groupBy("print").agg(F.min_by("keys", "doc_id").alias("keys"))
    bands = bands.select(F.xxhash64("print").alias("rep"), F.explode("keys").alias("bucket"))
    crowded = bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    bands = written(bands.join(crowded.hint(JOIN), "bucket"), "bands")
    firsts = usable.groupBy("print").agg(F.min(row).alias("first")).select("print", F.xxhash64("print").alias("rep"), "first")
    firsts = written(firsts, "firsts")
    links, classes_of = _linked(bands, rows, firsts, words, threshold)
    # of linked sets, the smallest row of their class; others are classes of their own
    of = classes_of.join(firsts.select(F.col("rep").alias("node"), "first").hint(JOIN), "node")
    least = of.groupBy("component").agg(F.min("first").alias("least"))
    least = classes_of.join(least.hint(JOIN), "component").select(F.col("node").alias("rep"), "least")
    reps = firsts.join(least.hint(JOIN), "rep", "left").select("print", F.coalesce("least", "first").alias("of"))
    own = signed.select("doc_id", "mark", "print").join(reps.hint(JOIN), "print", "left")
    kept = F.when(F.col("doc_id").isNotNull(), (F.col("of.doc_id") == F.col("doc_id")) & (F.col("of.mark") == F.col("mark")))
    class_id = F.coalesce("of.doc_id", "doc_id").alias("class_id")
    return own.select("doc_id", "mark", class_id, F.coalesce(kept, F.lit(True)).alias("kept"))


def _linked(bands: DataFrame, rows: DataFrame, firsts: DataFrame, words: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Verified links of all candidates and the classes they connect."""
    wanted = bands.select("rep").distinct().join(firsts.hint(JOIN), "rep").select("rep", "first.doc_id", "first.mark")
    # rows that repeat an id and a text count once
    texts = rows.join(wanted.hint(JOIN), ["doc_id", "mark"]).filter("text is not null").groupBy("rep").agg(F.min("text").alias("text"))
    sets = written(_shingle_sets(texts, words), "shingles")
    nearness = bands.groupBy("rep").agg(F.sum("members").alias("shared"))
    ranked = written(bands.join(nearness.hint(JOIN), "rep").select("bucket", "rep", "shared"), "ranked")
    left = ranked.withColumns({"component": F.col("rep"), "centres": F.array().cast("array<long>")})
    links = None
    for turn in range(ROUNDS + 1):
        open_ = left.filter(~F.array_contains("centres", F.col("rep")))
        if turn < ROUNDS:
            # a centre outside the classes of earlier centres, which have met all members of other classes
            first = F.struct("shared", -F.col("rep"))
            centre = open_.filter(~F.array_contains("met", F.col("component"))) if turn else open_
            centre = centre.groupBy("bucket").agg(F.max_by("rep", first).alias("b"), F.max_by("component", first).alias("of_b"))
            pairs = open_.join(centre.hint(JOIN), "bucket").filter("component <> of_b").select(F.col("rep").alias("a"), "b")
        else:
            pairs = _possible_pairs(left.select("rep", "component").distinct(), sets, threshold)
        found = _verified(pairs.distinct(), sets, threshold)
        links = written(found if links is None else links.unionByName(found), "verified")
        classes = written(connected_components(links), "components")
        if turn == ROUNDS:
            break
        # buckets that still hold several classes go on, with the centres they have had and those centres' classes
        of = classes.withColumnRenamed("node", "rep")
        had = left.groupBy("bucket").agg(F.first("centres").alias("centres")).join(centre.select("bucket", "b").hint(JOIN), "bucket")
        now = ranked.join(of.hint(JOIN), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
        several = now.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi")
        now = now.join(several.select("bucket").hint(JOIN), "bucket").join(
            had.select("bucket", F.array_append("centres", F.col("b")).alias("centres")).hint(JOIN), "bucket"
        )
        met = now.filter(F.array_contains("centres", F.col("rep"))).groupBy("bucket").agg(F.collect_set("component").alias("met"))
        left = written(now.join(met.hint(JOIN), "bucket"), "left")
    return links, classes

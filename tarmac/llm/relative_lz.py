"""Removal of repeated passages by relative Lempel-Ziv parsing of documents against all documents.

A *window* is a run of W consecutive words of one document. A window is repeated if
its words also start anywhere else, in the same or another document. Every word
under a repeated window goes.

The reference is the corpus itself, cut into *phrases*: windows in a row that share
an anchor, their leftmost smallest K-word fingerprint. Equal windows have the same
anchor at the same place, so a document only has to be matched where its anchors
are indexed. The index lies in blocks by the hash of the anchor; it names, for each
phrase, the first place where the corpus has it. A document is parsed greedily: a
phrase that stands elsewhere as well is copied from there, and goes on for as long
as the next phrase is the next one at that place. These factors are W words or
longer. Where a factor ends, the phrase next to it shares an anchor with others but
is no copy as a whole; its windows are looked up one by one, so that nothing is lost
at a factor's boundary.

Most anchors occur once. Two fixed-size bit filters of anchors, at most 2^27 bits
each, keep such phrases from being shuffled and single windows from being carried
where no boundary needs them; they only save work, the joins decide.

Fingerprints are polynomials over 64-bit hashes of words, and two are compared at a
time (anchor and phrase, anchor and window), 128 bits in all. Words are compared
unchanged. Null and empty texts have no words; texts shorter than a window lose
none. Rows that are equal in id and text, ids null or not, are documents that
repeat each other. Long texts are handled whole. An empty table gives no rows.
Other columns are kept; a column of the name of an added one is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import (
    BATCH_ROWS, BATCH_ROWS_KEY, FILTER_BITS, SLICE_BYTES, bit_filter, byte_buffers, hand_back, mixed, passing, separators,
    slices, written,
)

ANCHOR_WORDS = 8

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
PHRASE = "key_a long, key_b long, first int, n int, anchor long, phrase long, windows array<long>"
FACTOR = "array<struct<start:int,words:int,reference:bigint,reference_start:int>>"


class Words:
    """The words of some rows: hashes, places in the bytes, and fingerprints of runs of them."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        self.data, ends = data[int(offsets[0]) : int(offsets[-1])], offsets - offsets[0]
        inside = ~separators()[self.data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        heads = ends[:-1][ends[:-1] < len(self.data)]
        begins[heads] = inside[heads]
        starts = np.flatnonzero(begins)
        self.place = np.flatnonzero(inside)
        first = np.searchsorted(self.place, starts)
        self.lengths = np.diff(np.append(first, len(self.place)))
        self.bounds = np.searchsorted(starts, ends)
        self.within = np.arange(len(self.place)) - np.repeat(first, self.lengths)
        self.first_char = first

    def fingerprints(self) -> None:
        """Prepare ``run``: sums of hash x base^i up to each word, and base^-i."""
        chars = self.data[self.place].astype(np.uint64) + np.uint64(1)
        powers = _powers(_BASE, int(self.lengths.max(initial=1)))
        hashes = np.add.reduceat(chars * powers[self.within], self.first_char) if len(self.first_char) else chars[:0]
        terms = mixed(hashes) * _powers(_BASE, len(hashes))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
        self.shift = _powers(_INVERSE, len(hashes) + 1)

    def run(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Fingerprints of the words from ``first`` up to, not including, ``last``."""
        return mixed((self.sums[last] - self.sums[first]) * self.shift[first])


def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(max(n, 1), base, np.uint64)
    powers[0] = 1
    return np.cumprod(powers, dtype=np.uint64)[:n]


def _leftmost_smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Where the smallest of each ``width`` values in a row stands, the leftmost one of equals; by doubling."""
    at, span = np.arange(len(values)), 1
    while span < width:
        step = min(span, width - span)
        left, right = at[:-step], at[step:]
        at = np.where(values[right] < values[left], right, left)
        span += step
    return at


def phrases_of(words: Words, window: int, anchor_words: int) -> tuple[np.ndarray, ...]:
    """Row, first window, number of windows, anchor and fingerprint of every phrase."""
    none = np.zeros(0, np.int64)
    total = int(words.bounds[-1])
    if total < window:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    words.fingerprints()
    starts = np.arange(total - anchor_words + 1)
    grams = words.run(starts, starts + anchor_words)
    at = _leftmost_smallest(grams, window - anchor_words + 1)
    row = np.repeat(np.arange(len(words.bounds) - 1), np.diff(words.bounds))
    whole = np.flatnonzero(row[: total - window + 1] == row[window - 1 :])
    at, rows = at[whole], row[whole]
    new = np.ones(len(whole), bool)
    new[1:] = (at[1:] != at[:-1]) | (rows[1:] != rows[:-1])
    heads = np.flatnonzero(new)
    first, n = whole[heads], np.diff(np.append(heads, len(whole)))
    text = words.run(first, first + n + window - 1) + mixed(n.astype(np.uint64))
    return rows[heads], first, n, grams[at[heads]], text


def phrases(keyed: DataFrame, window: int, anchor_words: int, filters: tuple | None = None) -> DataFrame:
    """Phrases of all texts of ``keyed`` (key_a, key_b, text).

    With ``filters`` only those whose anchor may be repeated; ``windows`` then holds
    their windows' fingerprints where the anchor may stand in different phrases.
    """
    _small_batches(keyed)

    def on_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = byte_buffers(batch.column(2))
            for low, high in slices(offsets, 4 * SLICE_BYTES):
                words = Words(data, offsets[low : high + 1])
                row, first, n, anchor, text = phrases_of(words, window, anchor_words)
                if filters:
                    keep = passing(filters[0], anchor)
                    row, first, n, anchor, text = row[keep], first[keep], n[keep], anchor[keep], text[keep]
                if not len(row):
                    continue
                rows = pa.array(low + row)
                if filters:
                    many = passing(filters[1], anchor)
                    sizes = np.where(many, n, 0)
                    ends = np.concatenate([[0], np.cumsum(sizes)])
                    start = np.repeat(first, sizes) + np.arange(ends[-1]) - np.repeat(ends[:-1], sizes)
                    windows = pa.ListArray.from_arrays(
                        pa.array(ends, pa.int32()), pa.array(words.run(start, start + window).view(np.int64)), mask=pa.array(~many)
                    )
                else:
                    windows = pa.nulls(len(row), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(rows), batch.column(1).take(rows),
                        pa.array(first - words.bounds[row], pa.int32()), pa.array(n, pa.int32()),
                        pa.array(anchor.view(np.int64)), pa.array(text.view(np.int64)), windows,
                    ],
                    ["key_a", "key_b", "first", "n", "anchor", "phrase", "windows"],
                )
        hand_back()

    return keyed.select("key_a", "key_b", "text").mapInArrow(on_batches, PHRASE)


def _small_batches(df: DataFrame) -> None:
    conf = df.sparkSession.conf
    if int(conf.get(BATCH_ROWS_KEY)) > BATCH_ROWS:
        conf.set(BATCH_ROWS_KEY, str(BATCH_ROWS))


def copies(
    docs: DataFrame, window: int = 35, doc_id: str = "doc_id", text: str = "text", filter_bits: int = FILTER_BITS
) -> DataFrame:
    """Per distinct document (key_a, key_b) its repeated ``pieces``: first window, number of windows, where they stand too.

    A piece is a phrase that stands elsewhere, or a single repeated window at a boundary (reference null).
    """
    anchor_words = min(ANCHOR_WORDS, window)
    keyed = _keyed(docs, doc_id, text)
    anchors = phrases(keyed, window, anchor_words).groupBy("anchor").agg(
        F.count(F.lit(1)).alias("times"), (F.min("phrase") < F.max("phrase")).alias("differ")
    )
    anchors = written(anchors.filter("times > 1").select("anchor", "differ"), "lz-anchors")
    n, n_differ = anchors.agg(F.count(F.lit(1)), F.count_if("differ")).first()
    keys = anchors.withColumnRenamed("anchor", "key")
    repeated = bit_filter(keys, n, most_bits=filter_bits)
    filters = repeated, bit_filter(keys.filter("differ"), n_differ, bits_per_key=32, slices_of_key=2, most_bits=filter_bits)

    found = written(phrases(keyed, window, anchor_words, filters), "lz-phrases")
    place = F.struct("key_a", "key_b", "first")
    index = found.groupBy("anchor", "phrase").agg(
        F.count(F.lit(1)).alias("times"), F.min(place).alias("reference"), F.first("windows").alias("windows")
    )
    index = written(index.filter("times > 1 or windows is not null"), "lz-index")

    copied = index.filter("times > 1").select("anchor", "phrase", "reference")
    whole = found.select("anchor", "phrase", "key_a", "key_b", "first", "n").join(copied, ["anchor", "phrase"])
    whole = whole.select(
        "key_a", "key_b", "first", "n", F.col("reference.key_a").alias("reference"), F.col("reference.first").alias("reference_first")
    )
    single = index.filter("windows is not null")
    windows = single.select("anchor", "times", F.explode("windows").alias("window"))
    windows = windows.groupBy("anchor", "window").agg(F.sum("times").alias("times")).filter("times > 1").drop("times")
    cut = single.filter("times = 1").select("anchor", "reference", F.posexplode("windows").alias("within", "window"))
    cut = cut.join(windows, ["anchor", "window"], "left_semi").select(
        "reference.key_a", "reference.key_b", (F.col("reference.first") + F.col("within")).alias("first"),
        F.lit(1).alias("n"), F.lit(None).cast("long").alias("reference"), F.lit(None).cast("int").alias("reference_first"),
    )
    piece = F.struct("first", "n", "reference", "reference_first")
    return whole.unionByName(cut).groupBy("key_a", "key_b").agg(F.collect_set(piece).alias("pieces"))


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Two 64-bit hashes of id and text name a document; rows equal in both share them."""
    one, other = docs[doc_id].cast("string"), docs[text]
    return docs.select(
        F.xxhash64(one, other).alias("key_a"), F.xxhash64(other, F.lit(1), one).alias("key_b"), other.alias("text"),
        F.struct(F.lit(0), *[docs[c] for c in docs.columns if c != text]).alias("rest"),
    )


def without_copies(
    docs: DataFrame, window: int = 35, doc_id: str = "doc_id", text: str = "text", filter_bits: int = FILTER_BITS
) -> DataFrame:
    """The rows with what is left of their text, joined by single blanks, and what was copied from where.

    Adds n_words, n_removed, kept_text and factors (start and number of words, the
    first hash of the document referred to and the word it starts at there; null
    for single windows at a boundary).
    """
    pieces = copies(docs, window, doc_id, text, filter_bits).withColumnsRenamed({"key_a": "piece_a", "key_b": "piece_b"})
    keyed = _keyed(docs, doc_id, text)
    rows = keyed.join(pieces, (F.col("key_a") == F.col("piece_a")) & (F.col("key_b") == F.col("piece_b")), "left")
    added = {"n_words": "long", "n_removed": "long", "kept_text": "string", "factors": FACTOR}
    kind = keyed.schema["rest"].dataType.simpleString()
    schema = ", ".join([f"rest {kind}", "text string", *(f"{c} {t}" for c, t in added.items())])

    def on_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            data, offsets = byte_buffers(whole.column(1))
            for low, high in slices(offsets, 4 * SLICE_BYTES):
                batch = whole.slice(low, high - low)
                parsed = parse(Words(data, offsets[low : high + 1]), batch.column(2), window)
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], *parsed], ["rest", "text", *added])
        hand_back()

    _small_batches(docs)
    out = rows.select("rest", "text", "pieces").mapInArrow(on_batches, schema)
    kept = [F.col("text").alias(text) if c == text else F.col(f"rest.`{c}`").alias(c) for c in docs.columns if c not in added]
    return out.select(*kept, *added)


def parse(words: Words, pieces: pa.ListArray, window: int) -> list[pa.Array]:
    """Word counts, kept texts and factors of some rows whose repeated pieces are known."""
    rows = len(words.bounds) - 1
    counts = np.diff(words.bounds)
    lists = pieces.fill_null([]) if pieces.null_count else pieces
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten()
    row = np.repeat(np.arange(rows), sizes)
    first = flat.field("first").to_numpy(zero_copy_only=False).astype(np.int64)
    n = flat.field("n").to_numpy(zero_copy_only=False).astype(np.int64)
    known = flat.field("reference").is_valid().to_numpy(zero_copy_only=False)
    reference = flat.field("reference").fill_null(0).to_numpy(zero_copy_only=False)
    there = flat.field("reference_first").fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    order = np.lexsort((first, row))
    row, first, n, known, reference, there = (x[order] for x in (row, first, n, known, reference, there))

    marks = np.zeros(int(words.bounds[-1]) + 1, np.int64)
    np.add.at(marks, words.bounds[row] + first, 1)
    np.add.at(marks, words.bounds[row] + first + n + window - 1, -1)
    removed = np.cumsum(marks)[:-1] > 0
    gone = np.concatenate([[0], np.cumsum(removed)])
    n_removed = gone[words.bounds[1:]] - gone[words.bounds[:-1]]

    # a factor goes on while the next phrase is the next one at its reference too
    goes_on = np.zeros(len(row), bool)
    goes_on[1:] = (row[1:] == row[:-1]) & (first[1:] == first[:-1] + n[:-1]) & (known[1:] == known[:-1])
    goes_on[1:] &= ~known[1:] | ((reference[1:] == reference[:-1]) & (there[1:] - there[:-1] == first[1:] - first[:-1]))
    heads = np.flatnonzero(~goes_on)
    length = np.add.reduceat(n, heads) + window - 1 if len(heads) else n
    ends = np.searchsorted(row[heads], np.arange(rows + 1))
    unknown = pa.array(~known[heads])
    factors = pa.StructArray.from_arrays(
        [
            pa.array(first[heads], pa.int32()), pa.array(length, pa.int32()),
            pa.array(reference[heads], pa.int64(), mask=unknown.to_numpy(zero_copy_only=False)),
            pa.array(there[heads], pa.int32(), mask=unknown.to_numpy(zero_copy_only=False)),
        ],
        ["start", "words", "reference", "reference_start"],
    )
    return [
        pa.array(counts, pa.int64()), pa.array(n_removed, pa.int64()), _joined(words, ~removed),
        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), factors),
    ]


def _joined(words: Words, kept: np.ndarray) -> pa.Array:
    """Each row's kept words with single blanks between them."""
    size = np.where(kept, words.lengths + 1, 0)
    ends = np.concatenate([[0], np.cumsum(size)])
    text = np.full(int(ends[-1]), 32, np.uint8)
    chars = np.repeat(kept, words.lengths)
    start = np.repeat(ends[:-1], words.lengths)[chars]
    text[start + words.within[chars]] = words.data[words.place[chars]]
    lasts = ends[words.bounds]
    some = lasts[1:] > lasts[:-1]
    text = np.delete(text, lasts[1:][some] - 1)
    offsets = lasts - np.concatenate([[0], np.cumsum(some)])
    return pa.StringArray.from_buffers(len(lasts) - 1, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(text))

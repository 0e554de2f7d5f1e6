"""Token ids in Simple-8b files.

A 64-bit word has a selector in its top four bits and sixty bits of data, which
hold as many ids as the widest of them allows. An id of more than sixty bits
escapes: its word points into a list of raw words. A document's words stand
alone; a block of documents lists ids, lengths and word offsets before the words, so that
any document is decoded without the others, whole selectors at a time.
Blocks are rows of Parquet files written by Spark, in the order of document ids.
"""

from __future__ import annotations

import json
import math
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.common import Remembered, byte_buffers, gathered, per_process, slices
from tarmac.sources.tables import fresh_folder

DATA_BITS = 60
#: Ids per word by selector; selector 0 is the escape.
COUNTS = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 1], np.int64)
WIDTHS = DATA_BITS // COUNTS
LAST_SELECTOR = 14
BLOCK_IDS = 1 << 16
RANGE_ROWS = 8192
MOST_RANGES = 20_000
#: Bytes of text whose distinct chunks are looked up together, and ids that are packed into words together.
BATCH_BYTES = 1 << 22
WORD_IDS = 1 << 18
#: So many documents that are not at their end yet are walked one by one rather than together.
FEW_DOCS = 24
#: Chunks remembered in each of two generations.
KNOWN_CHUNKS = 500_000
MAGIC = b"S8BLOCK1"

# The blanks of Unicode's White_Space property. Byte-level BPE parts text before each single space or line feed
# that stands between other characters, so a text without neighbouring blanks falls into independent chunks there.
_BLANK = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_CHUNK = re.compile(f" ?[^{_BLANK}]+|[{_BLANK}]+(?![^{_BLANK}])|[{_BLANK}]+")
# Patterns that Arrow looks for in many texts at once: neighbouring, leading, trailing or odd blanks, and commas or
# full stops that do not follow a letter or digit (after one, such a mark stands apart from it and from the blank that follows).
_ODD = (
    r"  | \n|\n |\n\n|^[ \n]|[ \n]$|[\t\x0b-\r\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
_JOINED_MARK = r"[^A-Za-z0-9\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}][.,]|^[.,]"
# a run of letters or of digits, with at most a space before it, goes to the byte-pair model in one piece
_ONE_PIECE = re.compile(r" ?(?:[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f]+|[0-9]+)")
# Bytes that byte-level vocabularies spell as the character of that number; the others, in order, from U+0100 on.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_SPACE = "\u0120"
_STAND_INS = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}


def _word_starts(following: np.ndarray, heads: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places where words begin, in order: from each document's head on along ``following``, all documents a step at a time."""
    order = np.argsort(-sizes, kind="stable")
    at, ends = heads[order], (heads + sizes)[order]
    steps = []
    while True:
        alive = at < ends
        at, ends = at[alive], ends[alive]
        if len(at) < FEW_DOCS:
            break
        steps.append(at)
        at = following[at]
    rest = []
    for place, end in zip(at.tolist(), ends.tolist(), strict=True):
        own = following[place:end].tolist()
        i = place
        while i < end:
            rest.append(i)
            i = own[i - place]
    return np.sort(np.concatenate([*steps, np.array(rest, np.int64)]))


def encode_words(values: np.ndarray, offsets: np.ndarray | None = None) -> tuple[list[np.ndarray], list[int]]:
    """Words of each document, its raw words last, and how many raw words there are. Offsets part the documents."""
    values = values.astype(np.uint64)
    offsets = np.array([0, len(values)]) if offsets is None else np.asarray(offsets)
    sizes, gap = np.diff(offsets), int(COUNTS.max()) - 1
    heads = offsets[:-1] + gap * np.arange(len(sizes))  # so many zeros after each document that no word spans two
    n = int(sizes.sum()) + gap * len(sizes)
    padded = np.zeros(n + gap, np.uint64)
    padded[np.arange(len(values)) + gap * np.repeat(np.arange(len(sizes)), sizes)] = values
    need = np.zeros(n + gap, np.int8)  # bits of each id, one more than there are for an escape
    need[:] = np.frexp(padded.astype(np.float64))[1]
    large = np.flatnonzero(need > 50)
    need[large] = [int(v).bit_length() for v in padded[large]]
    wide = np.flatnonzero(need > DATA_BITS)
    selector = np.zeros(n, np.int8)
    most, span = need.copy(), 1
    for s in range(LAST_SELECTOR, 0, -1):  # windows grow as selectors fall
        count = int(COUNTS[s])
        while span < count:
            step = min(span, count - span)
            most[: len(most) - step] = np.maximum(most[: len(most) - step], most[step:])
            span += step
        selector[most[:n] <= WIDTHS[s]] = s
    begun = _word_starts(np.arange(n) + COUNTS[selector], heads, sizes)
    ends = np.searchsorted(begun, heads + sizes).tolist()
    chosen = selector[begun].astype(np.int64)
    words = chosen.astype(np.uint64) << np.uint64(DATA_BITS)
    for s in np.unique(chosen):
        of = np.flatnonzero(chosen == s)
        if s == 0:  # place among the document's own raw words
            doc = np.searchsorted(heads, begun[of], "right") - 1
            words[of] |= (np.searchsorted(wide, begun[of]) - np.searchsorted(wide, heads[doc])).astype(np.uint64)
            continue
        at, data = begun[of], words[of]
        for k in range(int(COUNTS[s])):
            data |= padded[at + k] << np.uint64(k * int(WIDTHS[s]))
        words[of] = data
    parts = np.split(words, ends[:-1]) if ends else []
    if not len(wide):
        return parts, [0] * len(parts)
    tails = [padded[wide[(wide >= a) & (wide < a + z)]] for a, z in zip(heads, sizes, strict=True)]
    return [np.append(w, t) for w, t in zip(parts, tails, strict=True)], [len(t) for t in tails]


def _decode_packed(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All values of a run of words, escapes as places among raw words, and where each word's values start."""
    selectors = (packed >> np.uint64(DATA_BITS)).astype(np.int64)
    counts = COUNTS[selectors]
    starts = np.append(0, np.cumsum(counts))
    out = np.zeros(int(starts[-1]), np.uint64)
    for s in np.unique(selectors):
        of = np.flatnonzero(selectors == s)
        at, data, mask = starts[of], packed[of], np.uint64((1 << int(WIDTHS[s])) - 1)
        for k in range(int(COUNTS[s])):
            out[at + k] = (data >> np.uint64(k * int(WIDTHS[s]))) & mask
    return out, starts


def decode_words(words: np.ndarray, raw: int, n: int) -> np.ndarray:
    """The n ids of one document's words."""
    packed, tail = words[: len(words) - raw], words[len(words) - raw :]
    out, starts = _decode_packed(packed)
    escapes = starts[:-1][packed >> np.uint64(DATA_BITS) == 0]
    out[escapes] = tail[out[escapes].astype(np.int64)]
    return out[:n]


def pack_block(docs: list[tuple[int | None, int, int, bytes]]) -> bytes:
    """One block of (doc id, number of ids, raw words, words) rows."""
    known = np.array([d[0] is not None for d in docs], np.int64)
    ids = np.array([d[0] or 0 for d in docs], np.int64)
    lengths, raws = np.array([d[1] for d in docs], np.int64), np.array([d[2] for d in docs], np.int64)
    offsets = np.cumsum([0, *(len(d[3]) // 8 for d in docs)], dtype=np.int64)
    head = np.array([len(docs)], np.int64)
    return MAGIC + b"".join(x.astype("<i8").tobytes() for x in (head, known, ids, lengths, raws, offsets)) + b"".join(d[3] for d in docs)


def unpack_block(data: bytes) -> Iterator[tuple[int | None, np.ndarray]]:
    """(doc id, ids) of every document of a block."""
    if data[: len(MAGIC)] != MAGIC:
        raise ValueError("not a block of token ids")
    at = len(MAGIC)
    n = int(np.frombuffer(data, "<i8", 1, at)[0])
    known, ids, lengths, raws = np.frombuffer(data, "<i8", 4 * n, at + 8).reshape(4, n)
    offsets = np.frombuffer(data, "<i8", n + 1, at + 8 + 32 * n)
    words = np.frombuffer(data, "<u8", int(offsets[-1]), at + 8 + 32 * n + 8 * (n + 1))
    names = [int(i) if k else None for i, k in zip(ids, known, strict=True)]
    if raws.any():
        for k in range(n):
            yield names[k], decode_words(words[offsets[k] : offsets[k + 1]], int(raws[k]), int(lengths[k]))
        return
    values, starts = _decode_packed(words)
    for k in range(n):
        at = starts[offsets[k]]
        yield names[k], values[at : at + lengths[k]]


def _load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core already
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _byte_pairs(tokenizer):
    """The tokenizer's byte-pair model where chunks of one piece may go to it directly, else None."""
    rules = json.loads(tokenizer.to_str())
    parts = rules["pre_tokenizer"] or {}
    plain = rules["normalizer"] is None and rules["truncation"] is None and rules["padding"] is None
    parted = parts.get("type") == "ByteLevel" and parts.get("use_regex") and not parts.get("add_prefix_space")
    return tokenizer.model if plain and parted and rules["model"]["type"] == "BPE" else None


def _encode_chunks(tokenizer, model, chunks: list[str]) -> list[bytes]:
    """Ids of each chunk. The model alone is several times faster than the way through the pre-tokenizer."""
    out: list[bytes | None] = [None] * len(chunks)
    others = []
    for k, chunk in enumerate(chunks):
        if model is not None and _ONE_PIECE.fullmatch(chunk):
            spelt = chunk if chunk.isascii() else chunk.encode().decode("latin-1").translate(_STAND_INS)
            ids = [t.id for t in model.tokenize(_SPACE + spelt[1:] if chunk[0] == " " else spelt)]
            out[k] = struct.pack(f"<{len(ids)}I", *ids)
        else:
            others.append(k)
    found = tokenizer.encode_batch_fast([chunks[k] for k in others], add_special_tokens=False)
    for k, encoding in zip(others, found, strict=True):
        ids = encoding.ids
        out[k] = struct.pack(f"<{len(ids)}I", *ids)
    return out


def _chunk_text(key: str) -> str:
    """What a chunk's key stands for: most chunks begin with a space, which their keys leave out."""
    return key[1:] if key[:1] == "\r" else key if key[:1] == "\n" else " " + key


#: Parts the keys of texts that are cut by the pattern; texts that hold it go to the tokenizer whole.
_PART = "\x01"


def _marked(text: str, odd: bool, joined: bool) -> str:
    """The keys of a text's chunks, parted by ``_PART`` in texts of odd blanks and by spaces in others.

    The chunks' ids, in a row, are the ids of the text. `\\r` marks a chunk that stands as it is.
    """
    if odd:
        return "\r" + (_PART + "\r").join(_CHUNK.findall(text))
    if not joined:
        text = text.replace(", ", " \r, ").replace(". ", " \r. ").replace(".\n", " \r.\n")
    return ("\r" + text).replace("\n", " \n")


def _chunk_ids(path: str, texts: list[str], parted_by: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of marked texts one after the other, and how many each has.

    Arrow splits the texts and numbers the distinct chunks; only those are looked up, and numpy gathers their ids.
    """
    tokenizer = per_process(f"tokenizer {path}", lambda: _load_tokenizer(path))
    model = per_process(f"byte pairs {path}", lambda: _byte_pairs(tokenizer))
    remembered: Remembered = per_process(f"chunks {path}", lambda: Remembered(KNOWN_CHUNKS))
    lists = pc.split_pattern(pa.array(texts, pa.large_string()), parted_by)
    return gathered(lists, remembered, lambda new: _encode_chunks(tokenizer, model, list(map(_chunk_text, new))))


def token_ids(path: str, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of whole texts one after the other, without the end id, and how many each text has.

    Each distinct chunk is encoded once per worker as long as it is remembered.
    """
    tokenizer = per_process(f"tokenizer {path}", lambda: _load_tokenizer(path))
    specials = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    ways: dict[str, tuple[list[int], list[str]]] = {_PART: ([], []), " ": ([], []), "whole": ([], [])}
    column = pa.array(texts, pa.large_string())
    odd, joined = (pc.match_substring_regex(column, pattern).to_pylist() for pattern in (_ODD, _JOINED_MARK))
    for k, text in enumerate(texts):
        if not text:
            continue
        if _PART in text or any(s in text for s in specials):  # a special token may span chunks
            way, marked = "whole", text
        else:
            way, marked = _PART if odd[k] else " ", _marked(text, odd[k], joined[k])
        ways[way][0].append(k)
        ways[way][1].append(marked)
    sizes = np.zeros(len(texts), np.int64)
    found = []
    for way, (places, own) in ways.items():
        if not own:
            continue
        if way == "whole":
            lists = [np.array(tokenizer.encode(x, add_special_tokens=False).ids, "<u4") for x in own]
            ids, n = np.concatenate(lists), np.array([len(x) for x in lists])
        else:
            ids, n = _chunk_ids(path, own, way)
        sizes[places] = n
        found.append((np.array(places), ids, n))
    starts = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), "<u4")
    for places, ids, n in found:
        out[np.repeat(starts[places] - (np.cumsum(n) - n), n) + np.arange(len(ids))] = ids
    return out, sizes


def _in_slices(ids: np.ndarray, sizes: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    """Raw words' numbers and words of all documents, some ``WORD_IDS`` ids at a time."""
    ends = np.append(0, np.cumsum(sizes))
    raws: list[int] = []
    coded: list[np.ndarray] = []
    for low, high in slices(ends, WORD_IDS):
        words, raw = encode_words(ids[ends[low] : ends[high]], ends[low : high + 1] - ends[low])
        coded += words
        raws += raw
    return raws, coded


def _packed_ranges(tokenizer: str, end_id: int):
    """Encodes the sorted rows of a range and packs them into blocks as they come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("before", pa.int64()), ("n_ids", pa.int64()), ("data", pa.binary())])
        held: list[tuple[int | None, int, int, bytes]] = []
        part, block, before, own = 0, 0, 0, 0

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"part": part, "block": block, "before": before, "n_ids": own, "data": pack_block(held)}], schema)

        for batch in batches:
            for low, high in slices(byte_buffers(batch.column("text"))[1], BATCH_BYTES):
                rows = batch.slice(low, high - low)
                part = rows.column("part")[0].as_py()
                ids, sizes = token_ids(tokenizer, rows.column("text").to_pylist())
                ids = np.insert(ids, np.cumsum(sizes), end_id)
                sizes = sizes + 1
                for doc_id, size, raw, words in zip(rows.column("doc_id").to_pylist(), sizes.tolist(), *_in_slices(ids, sizes), strict=True):
                    held.append((doc_id, size, raw, words.astype("<u8").tobytes()))
                    own += size
                    if own >= BLOCK_IDS:
                        yield close()
                        block, before, own = block + 1, before + own, 0
                        held.clear()
        if held:
            yield close()

    return run


def write_files(docs: DataFrame, path: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end_id: int = 0) -> None:
    """Encode all documents and write them as block files in ascending id order, null ids first.

    Texts are dealt by ranges of ids, ties by a hash of the text, so that one id may
    span ranges; each range is encoded in order as it is read. A block
    also keeps how many ids of its range come before it, so starts need no pass over the data.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).withColumn("tie", F.xxhash64("text"))
    ranges = min(MOST_RANGES, max(1, math.ceil(docs.select(doc_id).count() / RANGE_ROWS)))
    ranged = rows.repartitionByRange(ranges, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    blocks = ranged.select(F.spark_partition_id().alias("part"), "doc_id", "text").mapInArrow(
        _packed_ranges(tokenizer, end_id), "part int, block bigint, before bigint, n_ids bigint, data binary"
    )
    blocks.write.parquet(path)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids_crc32) from block files; start counts the ids of all documents before."""
    files = spark.read.schema("part int, block bigint, before bigint, n_ids bigint, data binary").parquet(path)
    totals = sorted(files.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())  # a row per file
    base, firsts = 0, []
    for row in totals:
        firsts.append((row["part"], base))
        base += row["n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("part", pa.int32()), ("doc_id", pa.int64()), ("within", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
        for batch in batches:
            for part, at, data in zip(*(batch.column(k) for k in range(3)), strict=True):
                rows, within = [], at.as_py()
                for doc_id, ids in unpack_block(data.as_py()):
                    crc = zlib.crc32(ids.astype("<u4").tobytes())
                    rows.append({"part": part.as_py(), "doc_id": doc_id, "within": within, "n_tokens": len(ids), "ids_crc32": crc})
                    within += len(ids)
                yield pa.RecordBatch.from_pylist(rows, schema)

    read = files.select("part", "before", "data").mapInArrow(run, "part int, doc_id bigint, within bigint, n_tokens bigint, ids_crc32 bigint")
    starts = spark.createDataFrame(firsts, "part int, base bigint")
    return read.join(starts, "part").select("doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end_id: int = 0) -> DataFrame:
    """Write a table's ids to block files in the shared folder and read them back.

    A null text counts as empty and has the end id alone. Rows that repeat an id
    stay rows of their own; null ids come first. An empty table gives no rows.
    """
    path = fresh_folder(docs.sparkSession, "token-files")
    write_files(docs, path, tokenizer, doc_id, text, end_id)
    return read_files(docs.sparkSession, path)

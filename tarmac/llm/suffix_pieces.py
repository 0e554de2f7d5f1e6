"""SentencePiece encoding and decoding by suffix-array matching.

The distinct words of a batch are concatenated and indexed by a suffix array.
Every piece of the vocabulary is looked up in it by binary search, which gives
all its occurrences as edges (position, length, piece). Sorted by position they
form a table in which the words are relaxed: starting from single characters,
each word repeatedly replaces the two neighbouring edges whose union is the
best-scored edge, leftmost first, until no union is an edge. That is the result
that byte-pair pieces define. Characters outside the vocabulary fall back to bytes.
"""

from __future__ import annotations

import codecs
import heapq
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import Remembered, gathered, per_process, with_columns_from_text

SPACE = "▁"
NO_EDGE = np.iinfo(np.int32).max
#: The number after those of all characters.
GAP = 0x110000
BATCH_CHARS = 1 << 16
#: Bytes of texts that a worker encodes together, besides longer texts, which come alone: their ids and words take many times as much.
TEXT_BYTES = 1 << 19
LONG_WORD = 256
#: Words remembered in each of two generations.
KNOWN_WORDS = 60_000
NORMAL, UNKNOWN, BYTE = 1, 2, 6


@dataclass
class Pieces:
    """What encoding needs of a model: pieces that may match, ranks by falling score, and byte pieces."""

    name: str
    pieces: list[str]
    ids: np.ndarray
    ranks: np.ndarray
    lengths: np.ndarray
    byte_ids: list[int]
    surfaces: list[bytes]
    longest: int
    splits_blanks: bool
    splits_lines: bool


def load_pieces(path: str) -> Pieces:
    """Read a byte-pair model with byte fallback and an identity normaliser that puts a blank before each text."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    rules = model.normalizer_spec
    if model.trainer_spec.model_type != 2 or not model.trainer_spec.byte_fallback or rules.precompiled_charsmap:
        raise ValueError("only byte-pair models with byte fallback and no character map")
    if not rules.add_dummy_prefix or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
        raise ValueError("only models that put one blank before a text and keep all others")
    own = [(k, p.piece, p.score) for k, p in enumerate(model.pieces) if p.type == NORMAL]
    scores = np.array([s for _, _, s in own], np.float32)
    _, ranks = np.unique(-scores, return_inverse=True)
    byte_ids, surfaces = [0] * 256, []
    for k, p in enumerate(model.pieces):
        if p.type == BYTE:
            byte_ids[int(p.piece[1:-1], 16)] = k
            surfaces.append(bytes([int(p.piece[1:-1], 16)]))
        else:
            surfaces.append(p.piece.replace(SPACE, " ").encode() if p.type == NORMAL else b" \xe2\x81\x87 " if p.type == UNKNOWN else b"")
    pieces = [p for _, p, _ in own]
    return Pieces(path, pieces, np.array([k for k, _, _ in own], np.int32), ranks.astype(np.int32), np.array([len(p) for p in pieces]), byte_ids, surfaces,
                  max(map(len, pieces)), all(SPACE not in p.lstrip(SPACE) for p in pieces), all("\n" not in p for p in pieces))


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


@dataclass
class _Tables:
    """A model's pieces as edges are found by them: piece k, or none where k is the number of pieces."""

    codes: np.ndarray  # per code point: place in the alphabet of the pieces from 1 on, 0 for characters in no piece
    low: np.ndarray  # each piece's key, rising
    high: np.ndarray  # the least key beyond all texts that start with it
    lengths: np.ndarray
    ranks: np.ndarray
    ids: np.ndarray


def _tables(model: Pieces) -> _Tables:
    points = [_points(p) for p in model.pieces]
    alphabet = np.unique(np.concatenate([np.zeros(0, np.uint32), *points]))
    kind = np.uint16 if len(alphabet) < 0xFFFF else np.uint32
    codes = np.zeros(GAP + 1, kind)
    codes[alphabet] = np.arange(1, len(alphabet) + 1)
    low, high = [], []
    for x in points:
        x = codes[x].astype(codes.dtype.newbyteorder(">"))
        low.append(x.tobytes())
        x[-1] += 1
        high.append(x.tobytes())
    wide = f"S{codes.itemsize * model.longest}"
    order = np.argsort(np.array(low, wide), kind="stable")  # neighbouring keys are looked up one after the other
    return _Tables(codes, np.array(low, wide)[order], np.array(high, wide)[order], model.lengths[order],
                   np.append(model.ranks[order], NO_EDGE), np.append(model.ids[order], -1))


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Start positions of all suffixes, sorted by their first ``depth`` codes at least (prefix doubling from as many as 64 bits hold)."""
    n, bits = len(codes), 8 * codes.itemsize
    span = 64 // bits
    padded = np.append(codes, np.zeros(span, codes.dtype)).astype(np.uint64)
    rank = np.zeros(n, np.uint64)
    for k in range(span):
        rank = rank << np.uint64(bits) | padded[k : k + n]
    while span < depth:
        _, dense = np.unique(rank, return_inverse=True)
        rank = (dense + 1) * (n + 2)
        rank[:-span] += dense[span:] + 1 if span < n else 0
        span *= 2
    return np.argsort(rank)


def _keys(codes: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """The first ``depth`` codes from each start as byte strings that compare like the text."""
    padded = np.append(codes, np.zeros(depth, codes.dtype)).astype(codes.dtype.newbyteorder(">"))
    return np.lib.stride_tricks.sliding_window_view(padded, depth)[starts].view(f"S{codes.itemsize * depth}").ravel()


def edges(tables: _Tables, points: np.ndarray, depth: int) -> np.ndarray:
    """The piece that is the edge at (position, length - 1); the last place has none."""
    codes = tables.codes[points]
    order = suffix_array(codes, depth)
    suffixes = _keys(codes, order, depth)
    first, last = np.searchsorted(suffixes, tables.low, "left"), np.searchsorted(suffixes, tables.high, "left")
    found = last - first
    piece = np.repeat(np.arange(len(found)), found)
    within = np.arange(len(piece)) - np.repeat(np.cumsum(found) - found, found)
    position = order[first[piece] + within]
    edge = np.full(len(points) * depth + 1, len(found), np.uint16 if len(found) < 0xFFFF else np.int32)
    edge[position * depth + tables.lengths[piece] - 1] = piece  # a bucket for each (position, length) sorts the edges by position
    return edge


def _union_ranks(edge: np.ndarray, ranks: np.ndarray, depth: int, starts: np.ndarray, ends: np.ndarray, word: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Ranks of the unions of these edges with their neighbours on the right in the same word."""
    right = np.minimum(left + 1, len(starts) - 1)
    union = ends[right] - starts[left]
    fits = (right > left) & (word[right] == word[left]) & (union <= depth)
    return ranks[edge[np.where(fits, starts[left] * depth + union - 1, len(edge) - 1)]].astype(np.int64)


def _relax_together(edge: np.ndarray, ranks: np.ndarray, depth: int, starts: np.ndarray, ends: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Relax many short words at once, one union per word and round. Returns the edges left."""
    done_starts, done_ends = [], []
    rank = _union_ranks(edge, ranks, depth, starts, ends, word, np.arange(len(starts)))
    while len(starts):
        key = rank << 32 | np.arange(len(starts))
        heads = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        best = np.minimum.reduceat(key, heads)
        going = (best >> 32) != NO_EDGE
        sizes = np.diff(np.append(heads, len(starts)))
        live = np.repeat(going, sizes)
        done_starts.append(starts[~live])
        done_ends.append(ends[~live])
        left = best[going] & 0xFFFFFFFF
        ends[left] = ends[left + 1]
        live[left + 1] = False
        moved = (np.cumsum(live) - 1)[left]  # where the united edges are now; their unions and those before them are new
        starts, ends, word, rank = starts[live], ends[live], word[live], rank[live]
        changed = np.concatenate([moved, moved[moved > 0] - 1])
        rank[changed] = _union_ranks(edge, ranks, depth, starts, ends, word, changed)
    return np.concatenate(done_starts or [starts]), np.concatenate(done_ends or [ends])


def _relax_long(edge: np.ndarray, ranks: np.ndarray, depth: int, start: int, end: int) -> list[tuple[int, int]]:
    """Relax one long word with a queue of unions."""
    before = {p: p - 1 for p in range(start + 1, end)}
    after = {p: p + 1 for p in range(start, end)}  # where the edge at p ends
    queue: list[tuple[int, int, int, int]] = []

    def push(a: int) -> None:
        b = after.get(a)
        if b is not None and b < end and after[b] - a <= depth:
            rank = int(ranks[edge[a * depth + after[b] - a - 1]])
            if rank != NO_EDGE:
                heapq.heappush(queue, (rank, a, b, after[b]))

    for p in range(start, end - 1):
        push(p)
    while queue:
        _, a, b, c = heapq.heappop(queue)
        if after.get(a) != b or after.get(b) != c:
            continue
        after[a] = c
        del after[b], before[b]
        if c < end:
            before[c] = a
        push(a)
        if a > start:
            push(before[a])
    return sorted(after.items())


def encode_distinct(model: Pieces, words: list[str]) -> list[bytes]:
    """Piece ids of each word as little-endian unsigned 32-bit integers."""
    out: list[bytes] = []
    at = 0
    while at < len(words):
        last, chars = at, 0
        while last < len(words) and (last == at or chars + len(words[last]) < BATCH_CHARS):
            chars += len(words[last]) + 1
            last += 1
        out += _encode_batch(model, words[at:last])
        at = last
    return out


def _encode_batch(model: Pieces, words: list[str]) -> list[bytes]:
    depth = model.longest
    tables: _Tables = per_process(f"piece tables {model.name}", lambda: _tables(model))
    lengths = np.array([len(w) for w in words])
    offsets = np.cumsum(lengths + 1) - lengths - 1
    points = _points("\0".join(words) + "\0").copy()
    gaps = offsets + lengths
    points[gaps] = GAP  # parts words; in no piece
    edge = edges(tables, points, depth)
    short = np.flatnonzero((lengths <= LONG_WORD) & (lengths > 0))
    owner = np.repeat(short, lengths[short])
    starts = np.arange(len(owner)) - np.repeat(np.cumsum(lengths[short]) - lengths[short], lengths[short]) + offsets[owner]
    starts, ends = _relax_together(edge, tables.ranks, depth, starts, starts + 1, owner)
    sizes = np.zeros(len(points), np.int32)
    sizes[starts] = ends - starts
    for k in np.flatnonzero(lengths > LONG_WORD):
        pairs = np.array(_relax_long(edge, tables.ranks, depth, int(offsets[k]), int(gaps[k])))
        sizes[pairs[:, 0]] = pairs[:, 1] - pairs[:, 0]
    starts = np.flatnonzero(sizes)
    found = tables.ids[edge[starts * depth + sizes[starts] - 1]].astype(np.int64)
    counts = np.ones(len(found), np.int64)
    unknown = np.flatnonzero(found < 0)
    if len(unknown):
        spelled = [[model.byte_ids[b] for b in chr(points[starts[k]]).encode("utf-8", "surrogatepass")] for k in unknown]
        counts[unknown] = [len(x) for x in spelled]
        places = np.cumsum(counts) - counts
        full = np.repeat(found, counts)
        for k, x in zip(unknown, spelled, strict=True):
            full[places[k] : places[k] + len(x)] = x
        found = full
    edges_before, ids_before = np.searchsorted(starts, np.append(offsets, len(points))), np.append(0, np.cumsum(counts)) * 4
    data, ends_at = found.astype("<u4").tobytes(), ids_before[edges_before].tolist()
    return [data[a:b] for a, b in zip(ends_at[:-1], ends_at[1:], strict=True)]


def _word_pattern(model: Pieces) -> re.Pattern:
    """Parts texts only where no piece of the vocabulary reaches across."""
    if not model.splits_blanks:
        return re.compile("(?s).+")
    line = "\n" if model.splits_lines else ""
    return re.compile(f"{SPACE}*[^{SPACE}{line}]+|{SPACE}+" + ("|\n" if line else ""))


def _word(key: str) -> str:
    """What a word's key stands for: most words begin with a blank, which their keys leave out; `\\r` marks one that stands as it is."""
    return key[1:] if key[:1] == "\r" else key if key == "\n" else SPACE + key


def encode_texts(model: Pieces, texts: list[str | None]) -> list[bytes]:
    """Ids of whole texts as bytes; each distinct word is encoded once per worker while it is remembered.

    Of texts without neighbouring or leading blanks, Arrow makes the words; the pattern parts the others.
    """
    pattern = per_process(f"piece words {model.name}", lambda: _word_pattern(model))
    remembered: Remembered = per_process(f"known pieces {model.name}", lambda: Remembered(KNOWN_WORDS))
    plain, odd = ([], []), ([], [])
    for k, x in enumerate(texts):
        if not x:
            continue
        if not (model.splits_blanks and model.splits_lines) or "  " in x or x[0] == " " or "\r" in x or SPACE in x:
            odd[0].append(k)
            odd[1].append(["\r" + w for w in pattern.findall(SPACE + x.replace(" ", SPACE))])
        else:
            plain[0].append(k)
            plain[1].append(x.replace("\n", " \n \r"))
    out = [b""] * len(texts)
    ways = (plain[0], pc.split_pattern(pa.array(plain[1], pa.large_string()), " ")), (odd[0], pa.array(odd[1], pa.list_(pa.large_string())))
    for places, keys in ways:
        if places:
            ids, sizes = gathered(keys, remembered, lambda new: encode_distinct(model, list(map(_word, new))))
            data, ends = ids.tobytes(), np.append(0, np.cumsum(sizes) * 4).tolist()
            for k, a, b in zip(places, ends[:-1], ends[1:], strict=True):
                out[k] = data[a:b]
    return out


def decode_ids(model: Pieces, ids: np.ndarray) -> str:
    """The text of a sequence of ids; a byte that belongs to no character becomes U+FFFD."""
    data = b"".join(map(model.surfaces.__getitem__, ids.tolist()))
    codecs.register_error("bytewise", lambda e: ("�", e.start + 1))
    return data[1:].decode("utf-8", "bytewise") if data[:1] == b" " else data.decode("utf-8", "bytewise")


def encode(docs: DataFrame, model: Pieces, text: str = "text") -> DataFrame:
    """The other columns and, in place of the text: ``ids``, ``n_tokens``, ``ids_crc32`` and ``restored``.

    ``ids_crc32`` is of the ids as little-endian unsigned 32-bit integers;
    ``restored`` tells whether decoding them gives the text again, the piece mark
    U+2581 counting as a blank. Null and empty texts have no ids and are restored.
    """

    def run(column: pa.Array) -> list[pa.Array]:
        texts = column.to_pylist()
        coded = encode_texts(model, texts)
        restored = [decode_ids(model, np.frombuffer(data, "<u4")) == (x or "").replace(SPACE, " ") for x, data in zip(texts, coded, strict=True)]
        sizes = np.array([len(x) // 4 for x in coded], np.int64)
        values = pa.array(np.frombuffer(b"".join(coded), "<i4"))
        ids = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), values)
        return [ids, pa.array(sizes), pa.array([zlib.crc32(x) for x in coded], pa.int64()), pa.array(restored, pa.bool_())]

    added = {"ids": "array<int>", "n_tokens": "bigint", "ids_crc32": "bigint", "restored": "boolean"}
    return with_columns_from_text(docs, text, added, run, TEXT_BYTES)


def decode(rows: DataFrame, model: Pieces, ids: str = "ids", text: str = "text") -> DataFrame:
    """The other columns and the decoded text in place of the ids; null ids give a null text."""

    def run(column: pa.Array) -> list[pa.Array]:
        return [pa.array([None if x is None else decode_ids(model, np.array(x, np.int64)) for x in column.to_pylist()], pa.string())]

    return with_columns_from_text(rows.withColumn(ids, F.col(ids)), ids, {text: "string"}, run)

"""Language identification by prediction by partial matching.

Every language has a tree of byte contexts of up to three bytes with the counts
of the byte that follows. A text's code length under a language is the sum over
its bytes of -log2 p, where an unseen byte escapes to the next shorter context
(escape method C: with n symbols seen, d of them distinct, p(s) = n_s / (n + d)
and p(escape) = d / (n + d)) and, below the empty context, to a uniform byte.
The counts are frozen after training, so code lengths are exact sums and do not
depend on the order of texts. The shortest code wins.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import byte_buffers, hand_back, slices, with_columns_from_text

ORDER = 3
UNKNOWN = "und"
#: Bounds of the labelled sample, per language, and of all languages together.
MAX_ROWS = 1000
MAX_BYTES = 1_500_000
TOTAL_BYTES = 24_000_000
#: keys are cut into 2^12 slices by hash before the first ones of a language are ordered
SLICE_BITS = 12
#: Up to this size the statistics are folded into one dense table.
DENSE_BYTES = 200_000_000


@dataclass
class ContextTrees:
    """Frozen statistics, folded into one table of bits per (context, byte class, language)."""

    languages: list[str]
    classes: np.ndarray  # class of each byte; bytes never seen share the last class
    contexts: np.ndarray  # id of each triple of classes
    bits: np.ndarray  # (contexts * classes, languages)

    @property
    def width(self) -> int:
        return int(self.classes.max()) + 1


@dataclass
class SparseTrees:
    """Frozen statistics of very many languages: of each language only what it has seen.

    A language has for each order (symbol keys, their bits, context keys, their
    escapes' bits), keys rising; a key is made of classes of bytes.
    """

    languages: list[str]
    classes: np.ndarray
    width: int
    trees: list[list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]]


def _sparse_tree(codes: np.ndarray, width: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    grams = _triples(codes, width) * width + codes[ORDER:]
    out = []
    for order in range(ORDER + 1):
        keys, counts = np.unique(grams % width ** (order + 1), return_counts=True)
        contexts, first, distinct = np.unique(keys // width, return_index=True, return_counts=True)
        total = np.add.reduceat(counts, first) + distinct
        own = -np.log2(counts / np.repeat(total, distinct))
        out.append((keys, own.astype(np.float32), contexts, -np.log2(distinct / total).astype(np.float32)))
    return out


def _found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _sparse_bits(tree: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], grams: np.ndarray, width: int) -> np.ndarray:
    """Bits of the last byte of every gram after those before it."""
    bits = np.full(len(grams), 8.0)
    for order, (keys, own, contexts, escape) in enumerate(tree):
        wanted = grams % width ** (order + 1)
        context, known = _found(contexts, wanted // width)
        symbol, seen = _found(keys, wanted)
        bits = np.where(seen, own[symbol], np.where(known, bits + escape[context], bits))
    return bits


def _dense_bits(codes: np.ndarray, width: int, unseen_bits: np.ndarray) -> np.ndarray:
    """Bits of every symbol after every context of length 2, each by way of the shorter ones.

    ``codes`` holds the class of each training byte, with ``ORDER`` blanks before each text.
    """
    bits = unseen_bits
    for order in range(ORDER):
        key = np.zeros(len(codes) - ORDER, np.int64)
        for back in range(order, -1, -1):
            key = key * width + codes[ORDER - back : len(codes) - back]
        counts = np.bincount(key, minlength=width ** (order + 1)).reshape(-1, width).astype(np.float64)
        bits = _with_escape(counts, np.tile(bits, (len(counts) // len(bits), 1)))
    return bits


def _with_escape(counts: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Bits after each context, given those after its suffix. A context never seen costs no escape."""
    seen = counts.sum(1, keepdims=True)
    distinct = (counts > 0).sum(1, keepdims=True)
    with np.errstate(divide="ignore", invalid="ignore"):
        own = -np.log2(counts / (seen + distinct))
        escape = -np.log2(distinct / (seen + distinct))
    return np.where(seen == 0, shorter, np.where(counts > 0, own, shorter + escape))


def _triples(codes: np.ndarray, width: int) -> np.ndarray:
    return (codes[:-3] * width + codes[1:-2]) * width + codes[2:-1]


def train(samples: dict[str, list[bytes]]) -> ContextTrees | SparseTrees:
    """Context trees of each language's texts. Languages without any byte of text are left out."""
    languages = sorted(lang for lang, texts in samples.items() if any(texts))
    if not languages:
        return ContextTrees([], np.zeros(256, np.int64), np.zeros(1, np.int32), np.zeros((1, 0), np.float32))
    used = np.unique(np.frombuffer(b" ".join(x for lang in languages for x in samples[lang]) + b" ", np.uint8))
    classes = np.full(256, len(used), np.int64)
    classes[used] = np.arange(len(used))
    width = len(used) + 1
    # below the empty context each byte has eight bits; the class of all unseen bytes stands for one of them
    unseen = np.full((1, width), 8.0)
    blank = np.full(ORDER, 32, np.uint8)
    coded = {}
    for lang in languages:
        parts = [y for x in samples[lang] for y in (blank, np.frombuffer(x, np.uint8))]
        coded[lang] = classes[np.concatenate(parts)].astype(np.int64)
    seen = np.unique(np.concatenate([np.unique(_triples(codes, width)) for codes in coded.values()]))
    if (width * width + len(seen)) * width * len(languages) * 4 > DENSE_BYTES:
        return SparseTrees(languages, classes, width, [_sparse_tree(coded[lang], width) for lang in languages])
    contexts = np.arange(width**3, dtype=np.int32) % (width * width)  # an unseen triple falls to its last two
    contexts[seen] = width * width + np.arange(len(seen), dtype=np.int32)
    bits = np.empty(((width * width + len(seen)), width, len(languages)), np.float32)
    for k, lang in enumerate(languages):
        shorter = _dense_bits(coded[lang], width, unseen)
        where = np.searchsorted(seen, _triples(coded[lang], width))
        counts = np.bincount(where * width + coded[lang][3:], minlength=len(seen) * width).reshape(-1, width)
        bits[: width * width, :, k] = shorter
        bits[width * width :, :, k] = _with_escape(counts.astype(np.float64), shorter[seen % (width * width)])
    return ContextTrees(languages, classes, contexts, bits.reshape(-1, len(languages)))


def code_lengths(model: ContextTrees | SparseTrees, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bits of each row under each language. Rows are cut into pieces for the work, with their contexts kept."""
    rows, width = len(offsets) - 1, model.width
    out = np.zeros((rows, len(model.languages)))
    piece = 1 << 18
    for first, last in slices(offsets, piece):
        lo, hi = int(offsets[first]), int(offsets[last])
        for at in range(lo, hi, piece):
            end = min(at + piece, hi)
            codes = np.full(end - at + ORDER, model.classes[32], np.int64)
            back = min(ORDER, at - lo)
            codes[ORDER - back :] = model.classes[data[at - back : end]]
            heads = offsets[first:last]
            heads = heads[(heads >= at) & (heads < end)] - at
            context = codes[:-3] * width
            context += codes[1:-2]
            context *= width
            context += codes[2:-1]
            blank = model.classes[32]
            for k in range(ORDER):  # near the start of a row, what lies before it counts as blank
                here = heads[heads + k < end - at] + k
                before = [codes[here + j] if j >= ORDER - k else np.full(len(here), blank) for j in range(ORDER)]
                nearer = offsets[np.searchsorted(offsets, here + at, "right") - 1] - at
                fits = nearer == here - k
                key = (before[0] * width + before[1]) * width + before[2]
                context[here[fits]] = key[fits]
            starts = np.unique(np.append(0, heads))
            owner = np.searchsorted(offsets, starts + at, "right") - 1
            if isinstance(model, SparseTrees):
                grams, place = np.unique(context * width + codes[3:], return_inverse=True)
                for k, tree in enumerate(model.trees):
                    bits = _sparse_bits(tree, grams, width)[place]
                    np.add.at(out[:, k], owner, np.add.reduceat(bits, starts))
                continue
            entry = model.contexts[context].astype(np.int64) * width + codes[3:]
            np.add.at(out, owner, np.add.reduceat(model.bits[entry], starts, axis=0, dtype=np.float64))
    return out


def predict(model: ContextTrees | SparseTrees, column: pa.Array) -> tuple[list[str], np.ndarray]:
    """Language and score of each text. The score is the share of 2^-bits per 64 bytes that the winner has."""
    column = pa.array(column) if isinstance(column, list) else column
    if not model.languages:
        return [UNKNOWN] * len(column), np.zeros(len(column))
    data, offsets = byte_buffers(column)
    bits = code_lengths(model, data, offsets)
    per = bits / np.maximum(1.0, np.diff(offsets) / 64.0)[:, None]
    weight = np.exp2(per.min(1, keepdims=True) - per)
    best = bits.argmin(1)
    score = weight.max(1) / weight.sum(1)
    letters = np.asarray(pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False))
    names = [model.languages[k] if ok else UNKNOWN for k, ok in zip(best, letters, strict=True)]
    return names, np.where(letters, score, 0.0)


def _lowest_slices(keys: DataFrame, first: int) -> DataFrame:
    """The keys of each stratum in the lowest slices of ``_order`` that hold ``first`` of them.

    Keys are counted per slice before the shuffle, so that a stratum's task
    orders some more than ``first`` keys and not a share of all.
    """
    sliced = keys.withColumn("_slice", F.shiftright("_order", 64 - SLICE_BITS))
    counts = sliced.groupBy("stratum", "_slice").agg(F.count(F.lit(1)).alias("_keys"))
    lower = Window.partitionBy("stratum").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_lower", F.coalesce(F.sum("_keys").over(lower), F.lit(0)))
    last = counts.filter(F.col("_lower") < first).groupBy("stratum").agg(F.max("_slice").alias("_last"))
    return sliced.join(F.broadcast(last), "stratum").filter(F.col("_slice") <= F.col("_last")).select(*keys.columns)


def learn(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
          max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES, total_bytes: int = TOTAL_BYTES) -> ContextTrees | SparseTrees:
    """Train on a bounded sample of each language's rows; rows without id, text or language don't count.

    Every language is learned. ``max_rows`` and ``max_bytes`` bound what is gathered
    of each; many languages share ``total_bytes`` evenly. Of the rows with any text
    but blanks the first in the order of a hash are taken, and of a text above a
    hundredth of the bytes (more where that is very short) a piece from its middle.
    """
    rows = docs.select(F.col(doc_id).alias("id"), F.col(lang).alias("stratum"), F.col(text).alias("_text"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("stratum").isNotNull() & F.col("_text").rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.withColumn("_order", F.xxhash64(F.col("id").cast("string"), F.lit(11)))
    share = max(64, min(max_bytes, total_bytes // max(1, rows.select("stratum").distinct().count())))
    limit = max(share // 100, min(share // 4, 1000))
    first = min(max_rows, share // 64)
    rank = F.row_number().over(Window.partitionBy("stratum").orderBy("_order", "id"))
    chosen = _lowest_slices(rows.select("id", "stratum", "_order"), first).withColumn("_rank", rank).filter(F.col("_rank") <= first)
    # only keys are ordered; texts are read where they lie
    taken = rows.join(F.broadcast(chosen.select("id", "stratum").distinct()), ["id", "stratum"])
    length = F.length("_text")
    size = F.greatest(F.lit(1), F.floor(length * (limit / F.octet_length("_text"))).cast("int"))
    start = (F.floor((length - size) / 2) + 1).cast("int")
    piece = F.when(F.octet_length("_text") <= limit, F.col("_text")).otherwise(F.substring("_text", start, size))
    taken = taken.select("id", "stratum", "_order", piece.alias("_text")).withColumn("_bytes", F.octet_length("_text"))
    running = Window.partitionBy("stratum").orderBy("_order", "id", "_text").rowsBetween(Window.unboundedPreceding, -1)
    taken = taken.withColumn("_before", F.coalesce(F.sum("_bytes").over(running), F.lit(0)))
    samples: dict[str, list[bytes]] = {}
    for row in taken.filter(F.col("_before") + F.when(F.col("_before") > 0, F.col("_bytes")).otherwise(0) <= share).orderBy("_order", "stratum", "_text").collect():
        samples.setdefault(row["stratum"], []).append(row["_text"].encode())
    model = train(samples)
    samples.clear()
    hand_back()
    return model


def identify(docs: DataFrame, model: ContextTrees | SparseTrees, text: str = "text") -> DataFrame:
    """The rows with ``lang_pred`` and ``score`` in place of the text (columns of these names are replaced).

    Null texts and texts without a letter, empty ones included, get ``und`` and
    score 0, as does every text when nothing was learned. Whole texts count, in
    pieces, so that memory does not grow with a text's length.
    """

    def run(column: pa.Array) -> list[pa.Array]:
        names, score = predict(model, column)
        return [pa.array(names, pa.string()), pa.array(score, pa.float64())]

    return with_columns_from_text(docs, text, {"lang_pred": "string", "score": "double"}, run)

"""Quality score by compression: one zstandard dictionary of good text and one of bad text.

A text is cut into pieces; each is compressed with either dictionary. The
difference of the two total sizes, as a share of the text's own size, is negative
when the good dictionary knows the text better, and near zero for text that
either compresses to almost nothing, such as one word over and over. A falling
curve fitted on labelled rows that the dictionaries have not seen turns it into
the share of good rows at that difference.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import bounded_sample, byte_buffers, hand_back, label_keys, with_columns_from_text

DICTIONARY_BYTES = 64 * 1024
PIECE = 8 * 1024
LEVEL = 3
CUT = 0.3
#: Bounds of the labelled sample, both labels together.
MAX_ROWS = 6000
MAX_BYTES = 24_000_000


@dataclass
class CompressionScore:
    good: bytes
    bad: bytes
    knots: np.ndarray  # differences, rising
    values: np.ndarray  # scores at the knots, falling


def _dictionary(texts: list[bytes]) -> bytes:
    pieces = [x[at : at + PIECE] for x in texts for at in range(0, len(x), PIECE)]
    total = sum(map(len, pieces))
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(1024, total // 8)), pieces).as_bytes()
    except zstandard.ZstdError:  # too few pieces to train on: their own bytes serve as content
        return b"".join(pieces)[-DICTIONARY_BYTES:]


def _compressors(model: CompressionScore) -> list[zstandard.ZstdCompressor]:
    out = []
    for content in (model.good, model.bad):
        dictionary = zstandard.ZstdCompressionDict(content)
        dictionary.precompute_compress(level=LEVEL)
        out.append(zstandard.ZstdCompressor(dict_data=dictionary, write_content_size=False, write_dict_id=False))
    return out


def differences(model: CompressionScore, texts) -> np.ndarray:
    """(size with the good dictionary - size with the bad one) / size of the text, 0 for empty texts."""
    good, bad = _compressors(model)
    out = np.zeros(len(texts))
    for i, text in enumerate(texts):
        a = b = 0
        for at in range(0, len(text), PIECE):
            piece = text[at : at + PIECE]
            a += len(good.compress(piece))
            b += len(bad.compress(piece))
        out[i] = (a - b) / max(1, len(text))
    return out


def _scores(model: CompressionScore, texts) -> np.ndarray:
    return np.interp(differences(model, texts), model.knots, model.values)


def _falling_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The falling step curve nearest to the labels (pool adjacent violators), as knots between which one interpolates.

    Half a row of either label is added to each step, so that no score is 0 or 1.
    """
    order = np.argsort(x, kind="stable")
    steps: list[list[float]] = []  # weight, weighted label 1, weighted x
    for at, label, w in zip(x[order], y[order], weight[order], strict=True):
        steps.append([w, w * label, w * at])
        while len(steps) > 1 and steps[-2][1] * steps[-1][0] <= steps[-1][1] * steps[-2][0]:
            last = steps.pop()
            steps[-1] = [a + b for a, b in zip(steps[-1], last, strict=True)]
    w, ones, at = np.array(steps).T
    values = np.minimum.accumulate((ones + 0.5) / (w + 1))
    return at / w, values


def train(texts: list[bytes], labels: list[int], share: float | None = None) -> CompressionScore | None:
    """Dictionaries from two thirds of the texts, the curve from the others; None when a label is missing.

    For the curve, label 1 weighs as much as its ``share`` among the texts to be
    judged says (default: as it comes).
    """
    y = np.asarray(labels)
    kept = np.arange(len(y)) % 3 == 2
    dictionaries = [[x for x, k, own in zip(texts, labels, kept, strict=True) if k == label and not own and x] for label in (1, 0)]
    if not all(dictionaries) or len({*y[kept]}) < 2:
        return None
    model = CompressionScore(_dictionary(dictionaries[0]), _dictionary(dictionaries[1]), np.zeros(1), np.zeros(1))
    x, ones = differences(model, [t for t, own in zip(texts, kept, strict=True) if own]), y[kept]
    weight = np.ones(len(ones))
    if share is not None:
        weight = np.where(ones == 1, share / ones.mean(), (1 - share) / (1 - ones.mean()))
    model.knots, model.values = _falling_curve(x, ones, weight)
    return model


def learn(docs: DataFrame, labels: DataFrame, label: str, doc_id: str = "doc_id", text: str = "text",
          max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> tuple[CompressionScore | None, float]:
    """A model from a bounded sample of rows whose label is 0 or 1, and the share of label 1 among all of them.

    Half of the bounds go to each label.
    """
    keys = label_keys(labels, doc_id, label)
    ones, all_ = keys.agg(F.sum("stratum"), F.count("stratum")).first()
    share = ones / all_ if all_ else 0.0
    taken = bounded_sample(keys, docs.select(doc_id, text), doc_id, text, max_rows // 2, max_bytes // 2)
    model = train([r[text].encode() for r in taken], [r["stratum"] for r in taken], share)
    del taken
    hand_back()
    return model, share


def assess(docs: DataFrame, model: CompressionScore | None, prior: float, text: str = "text") -> DataFrame:
    """The rows with ``score`` and ``predicted`` in place of the text (columns of these names are replaced).

    A null text counts as empty; both get the curve's value at no difference.
    Without a model (a label without rows) every text gets the share of label 1.
    """

    def run(column: pa.Array) -> list[pa.Array]:
        if model is None:
            s = np.full(len(column), prior)
        else:
            data, offsets = byte_buffers(column)
            view = memoryview(data)
            s = _scores(model, [view[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)])
        return [pa.array(s, pa.float64()), pa.array((s >= CUT).astype(np.int32))]

    return with_columns_from_text(docs, text, {"score": "double", "predicted": "int"}, run)

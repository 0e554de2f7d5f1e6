"""Phrase collocations per language by best-first branch-and-bound growth.

A phrase of 2 to 5 words that occurs ``a`` times among ``n`` words scores, for each
cut into a first part that occurs ``l`` and a rest that occurs ``r`` times,
floor(1000 a n / (l r)); its lowest cut counts. Phrases grow from their first
words. Since a phrase is no commoner than its parts, ``a / r`` is at most 1, so no
phrase that begins with a word of ``l`` occurrences scores above floor(1000 n / l):
rare first words have the highest bounds. Each language's first words are grown in
that order, some octaves of their counts at a time; prefix counts give all ``l`` and
a bound for every phrase grown so far. Phrases whose bound may still reach a
language's result then get their remaining counts, best bounds first. A language
is settled when its k-th surviving score is known and every word not grown and
every phrase not counted has a lower bound.

A phrase does not survive if all its occurrences stand in one longer phrase. The
longer phrase then has the same count, and so has the phrase with one word added at
that side: it is enough to know whether one and the same word always stands before,
or always after it.

Counts are over whole texts and all languages. What a task looks for reaches it as
bit filters of at most 2^27 bits; a word or phrase that passes by chance is taken
out by an exact join of strings. Counts are combined per megabytes of text and again
before each shuffle, and no step gathers the phrases of a language in one task.

Letters A to Z are lower-cased. Pieces end at any of ``.,;:!?`` and at line breaks;
blanks and tabs part words. Null texts have no words, a null language is ``und``;
equal rows count as often as they occur. Equal scores are ordered by count, then by
phrase. Fewer phrases than asked for give fewer rows; an empty table gives none.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import (
    BATCH_ROWS, BATCH_ROWS_KEY, SLICE_BYTES, bit_filter, byte_buffers, hand_back, mixed, passing, slices, written,
)

LONGEST = 5
#: Words that the first round may grow from in any language, and its share of larger ones; later rounds take four times more.
ROUND_WORDS = 1 << 23
ROUND_SHARE = 1 / 32
#: Phrases that a round counts beyond those that the result asks for, in multiples of them.
AHEAD = 2
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_NONE = np.iinfo(np.int64).max


def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(max(n, 1), base, np.uint64)
    powers[0] = 1
    return np.cumprod(powers, dtype=np.uint64)[:n]


def _byte_classes() -> tuple[np.ndarray, np.ndarray]:
    breaks, blanks = np.zeros(256, bool), np.zeros(256, bool)
    breaks[[*b".,;:!?", 10, 11, 12, 13]] = True
    blanks[[32, 9]] = True
    return breaks, breaks | blanks


class Pieces:
    """The words of some rows: their pieces, fingerprints of runs of them, and their text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, languages: np.ndarray) -> None:
        data, ends = data[int(offsets[0]) : int(offsets[-1])], offsets - offsets[0]
        self.data = data + np.uint8(32) * ((data >= 65) & (data <= 90))
        breaks, outside = _byte_classes()
        inside = ~outside[self.data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        heads = ends[:-1][ends[:-1] < len(self.data)]
        begins[heads] = inside[heads]
        starts = np.flatnonzero(begins)
        self.place = np.flatnonzero(inside)
        first = np.searchsorted(self.place, starts)
        self.total = len(starts)
        self.lengths = np.diff(np.append(first, len(self.place)))
        self.row = np.searchsorted(ends, starts, "right") - 1
        piece = np.cumsum(breaks[self.data])[starts] + self.row
        self.left = np.searchsorted(piece, piece, "right") - np.arange(self.total)  # words from here to the piece's end
        self.starts_piece = np.ones(self.total, bool)
        self.starts_piece[1:] = piece[1:] != piece[:-1]
        self.first_char = first
        self.seed = mixed(languages.view(np.uint64))[self.row]
        chars = self.data[self.place].astype(np.uint64) + np.uint64(1)
        within = np.arange(len(self.place)) - np.repeat(first, self.lengths)
        hashes = np.add.reduceat(chars * _powers(_BASE, int(self.lengths.max(initial=1)))[within], first) if self.total else chars[:0]
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(hashes) * _powers(_BASE, self.total), dtype=np.uint64)])
        self.shift = _powers(_INVERSE, self.total + 1)

    def keys(self, first: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        """Fingerprints of the language and ``size`` words from ``first`` on."""
        run = (self.sums[first + size] - self.sums[first]) * self.shift[first]
        return mixed(mixed(run) + self.seed[first] + np.asarray(size).astype(np.uint64))

    def text(self, first: np.ndarray, size: np.ndarray) -> pa.Array:
        """Words from ``first`` on, joined by single blanks."""
        ends = np.concatenate([[0], np.cumsum(size)])
        word = np.repeat(first, size) + np.arange(ends[-1]) - np.repeat(ends[:-1], size)
        lengths = self.lengths[word] + 1
        to = np.concatenate([[0], np.cumsum(lengths)])
        out = np.full(int(to[-1]), 32, np.uint8)
        n = self.lengths[word]
        within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        out[np.repeat(to[:-1], n) + within] = self.data[self.place[np.repeat(self.first_char[word], n) + within]]
        out = np.delete(out, to[ends[1:]] - 1)
        offsets = to[ends] - np.arange(len(ends))
        return pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(out))


def _over_pieces(texts: DataFrame, schema: str, run: Callable[[Pieces], Iterator[tuple[np.ndarray, list[pa.Array]]]]) -> DataFrame:
    """What ``run`` finds in (lang, lang_key, text), a few megabytes at a time: places of words, whose languages are added, and columns."""

    def on_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = byte_buffers(batch.column(2))
            languages = batch.column(1).to_numpy(zero_copy_only=False)
            for low, high in slices(offsets, 4 * SLICE_BYTES):
                pieces = Pieces(data, offsets[low : high + 1], languages[low:high])
                for first, columns in run(pieces):
                    if len(first):
                        lang = batch.column(0).take(pa.array(low + pieces.row[first]))
                        yield pa.RecordBatch.from_arrays([lang, *columns], ["lang", *names])
        hand_back()

    names = [field.split()[0] for field in schema.split(", ")]
    conf = texts.sparkSession.conf
    if int(conf.get(BATCH_ROWS_KEY)) > BATCH_ROWS:
        conf.set(BATCH_ROWS_KEY, str(BATCH_ROWS))
    return texts.select("lang", F.xxhash64("lang").alias("lang_key"), "text").mapInArrow(on_batches, f"lang string, {schema}")


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order that brings equal keys together, where each group starts in it, and the groups' sizes."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    heads = np.flatnonzero(new)
    return order, heads, np.diff(np.append(heads, len(keys)))


def count_words(texts: DataFrame) -> DataFrame:
    """(lang, phrase, f) of all words."""

    def run(p: Pieces) -> Iterator:
        every = np.arange(p.total)
        order, heads, n = _distinct(p.keys(every, 1))
        first = order[heads]
        yield first, [p.text(first, np.ones(len(first), np.int64)), pa.array(n)]

    rows = _over_pieces(texts, "phrase string, f bigint", run)
    return rows.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def _grown_from(texts: DataFrame, prefixes: tuple, size: int, frequent: tuple, longest: int) -> DataFrame:
    """(lang, phrase, size, f) of phrases of ``size`` + 1 to ``longest`` words whose first ``size`` words may be among the prefixes.

    A phrase ends before a word that is itself too rare.
    """

    def run(p: Pieces) -> Iterator:
        every = np.arange(p.total)
        rare = np.append(np.flatnonzero(~passing(frequent, p.keys(every, 1))), p.total)
        reach = np.minimum(np.minimum(p.left, rare[np.searchsorted(rare, every)] - every), longest)
        at = np.flatnonzero(reach > size)
        at = at[passing(prefixes, p.keys(at, size))]
        order, first, n = _distinct(p.keys(at, reach[at]))
        at = at[order[first]]
        yield at, [p.text(at, reach[at]), pa.array(reach[at]), pa.array(n)]

    grown = _over_pieces(texts, "phrase string, size bigint, f bigint", run).groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f"))
    if longest == size + 1:
        return grown
    parts = grown.withColumn("words", F.split("phrase", " "))
    parts = parts.select("lang", "words", "f", F.explode(F.sequence(F.lit(size + 1), F.col("size").cast("int"))).alias("size"))
    phrase = F.array_join(F.slice("words", F.lit(1), F.col("size")), " ")
    return parts.groupBy("lang", phrase.alias("phrase"), F.col("size").cast("long").alias("size")).agg(F.sum("f").alias("f"))


def grow(texts: DataFrame, heads: DataFrame, frequent: tuple, least: int) -> DataFrame:
    """(lang, phrase, size, a, n) of all phrases that begin with one of ``heads`` (lang, phrase, n) and occur ``least`` times or more.

    Words grow to pairs, pairs that are frequent to triples, and frequent triples to four and five words at once.
    """
    grown, prefixes = [], heads
    for size, longest in ((1, 2), (2, 3), (3, LONGEST)):
        wanted = bit_filter(keyed(prefixes), prefixes.count(), bits_per_key=32, slices_of_key=2)
        new = _grown_from(texts, wanted, size, frequent, longest).filter(F.col("f") >= least)
        exact = prefixes.select("lang", F.col("phrase").alias("prefix"), "n")
        new = new.withColumn("prefix", F.expr(f"substring_index(phrase, ' ', {size})")).join(exact, ["lang", "prefix"])
        prefixes = written(new.select("lang", "phrase", "size", F.col("f").alias("a"), "n"), "grown")
        grown.append(prefixes)
        if prefixes.isEmpty():
            break
    rows = grown[0]
    for more in grown[1:]:
        rows = rows.unionByName(more)
    return rows


def keyed(phrases: DataFrame) -> DataFrame:
    """Fingerprints (``key``) of the phrases (lang, phrase)."""

    def run(p: Pieces) -> Iterator:
        rows, first = np.unique(p.row, return_index=True)
        size = np.diff(np.append(first, p.total))
        yield first, [pa.array(p.keys(first, size).view(np.int64))]

    return _over_pieces(phrases.withColumnRenamed("phrase", "text"), "key bigint", run).select("key")


def look_up(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(lang, phrase, f, framed) of the wanted phrases; framed if one and the same word always stands before, or after."""
    looked_for = bit_filter(keyed(wanted), wanted.count(), bits_per_key=32, slices_of_key=2)

    def neighbours(p: Pieces, words: np.ndarray, at: np.ndarray, there: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low = np.where(there, words[np.clip(at, 0, p.total - 1)], _NONE)
        return low, np.where(there, low, -_NONE)

    def run(p: Pieces) -> Iterator:
        words = p.keys(np.arange(p.total), 1).view(np.int64)
        for size in range(2, LONGEST):
            at = np.flatnonzero(p.left >= size)
            keys = p.keys(at, size)
            hit = passing(looked_for, keys)
            at, keys = at[hit], keys[hit]
            if not len(at):
                continue
            order, heads, n = _distinct(keys)
            at = at[order]
            columns = []
            for side, there in ((at - 1, ~p.starts_piece[at]), (at + size, p.left[at] > size)):
                low, high = neighbours(p, words, side, there)
                columns += [
                    pa.array(np.add.reduceat(there.astype(np.int64), heads)),
                    pa.array(np.minimum.reduceat(low, heads)), pa.array(np.maximum.reduceat(high, heads)),
                ]
            yield at[heads], [p.text(at[heads], np.full(len(heads), size)), pa.array(n), *columns]

    sides = [f"{side}_{what}" for side in ("before", "after") for what in ("n", "low", "high")]
    rows = _over_pieces(texts, ", ".join(["phrase string", "f bigint", *(f"{s} bigint" for s in sides)]), run)
    combine = {"n": F.sum, "low": F.min, "high": F.max}
    rows = rows.groupBy("lang", "phrase").agg(F.sum("f").alias("f"), *[combine[s.split("_")[1]](s).alias(s) for s in sides])
    framed = [
        (F.col(f"{side}_n") == F.col("f")) & (F.col(f"{side}_low") == F.col(f"{side}_high")) for side in ("before", "after")
    ]
    exact = rows.join(wanted.select("lang", "phrase"), ["lang", "phrase"], "left_semi")
    return exact.select("lang", "phrase", "f", (framed[0] | framed[1]).alias("framed"))


def scored(grown: DataFrame, known: DataFrame, seen: DataFrame) -> DataFrame:
    """Each grown phrase with the cut that counts, or a bound where a rest has not been counted.

    ``whole`` says that the score is final; ``framed`` is null until it is known.
    A rest not counted yet occurs at least as often as the phrase.
    """
    cut = F.explode(F.sequence(F.lit(1), F.col("size").cast("int") - 1)).alias("cut")
    cuts = grown.select("lang", "phrase", "size", "a", "n", cut)
    cuts = cuts.withColumn("left", F.expr("substring_index(phrase, ' ', cut)"))
    cuts = cuts.withColumn("right", F.expr("substring_index(phrase, ' ', cast(cut - size as int))"))
    left = known.select(F.col("lang").alias("left_lang"), F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = known.select(F.col("lang").alias("right_lang"), F.col("phrase").alias("right"), F.col("f").alias("r"))
    cuts = cuts.join(left, (cuts["lang"] == left["left_lang"]) & (cuts["left"] == left["left"])).drop("left_lang", left["left"])
    cuts = cuts.join(right, (cuts["lang"] == right["right_lang"]) & (cuts["right"] == right["right"]), "left").drop(
        "right_lang", right["right"]
    )
    wide = "decimal(38,0)"
    rest = F.coalesce("r", "a")
    score = F.expr(f"(cast(cast(1000 as decimal(4,0)) * cast(a as decimal(17,0)) * cast(n as decimal(17,0)) as {wide})) div "
                   f"(cast(cast(l as decimal(19,0)) * cast(coalesce(r, a) as decimal(19,0)) as {wide}))")
    best = cuts.groupBy("lang", "phrase", "size", "a", "n").agg(
        F.min(F.struct(score.alias("score"), "cut", "l", rest.alias("r"))).alias("best"), F.bool_and(F.col("r").isNotNull()).alias("counted")
    )
    best = best.join(seen.select("lang", "phrase", "framed"), ["lang", "phrase"], "left")
    framed = F.when(F.col("size") == LONGEST, F.lit(False)).otherwise(F.col("framed"))
    return best.select(
        "lang", "phrase", "size", "a", "n", "best.l", "best.r", "best.score", framed.alias("framed"),
        (F.col("counted") & framed.isNotNull()).alias("whole"),
    )


def ranked(rows: DataFrame, top: int) -> DataFrame:
    """The first ``top`` rows of each language with their rank; ranked in 64 slices before the whole."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    piece = F.pmod(F.xxhash64("phrase"), F.lit(64))
    rows = rows.withColumn("slice", piece)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "slice").orderBy(*order))).filter(F.col("rank") <= top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return rows.drop("slice")


def _octave(count: str) -> Column:
    return F.floor(F.log2(count) * 2).cast("int")


def mine(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = 100, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's best collocations."""
    texts = docs.select(F.coalesce(docs[lang].cast("string"), F.lit("und")).alias("lang"), docs[text].alias("text"))
    words = written(count_words(texts), "words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = words.filter(F.col("f") >= least).withColumn("octave", _octave("f"))
    frequent = written(frequent.join(totals, "lang"), "frequent-words")
    frequent_words = bit_filter(keyed(frequent), frequent.count())
    octaves = frequent.groupBy("lang", "octave", "n").agg(F.sum("f").alias("words"), F.min("f").alias("least_f"))
    rising = Window.partitionBy("lang").orderBy("octave")
    octaves = octaves.withColumn("so_far", F.sum("words").over(rising)).withColumn("bound", F.expr("1000 * n div least_f"))
    octaves = written(octaves, "octaves")

    edges = octaves.groupBy("lang").agg((F.min("octave") - 1).alias("edge"), F.lit(None).cast("long").alias("settled_score"))
    grown = seen = rows = None
    open_phrases = False
    for turn in range(1000):
        # grow the next first words of each language that may still hold better phrases
        ahead = octaves.join(edges, "lang").filter("octave > edge and (settled_score is null or bound >= settled_score)")
        budget = F.greatest(F.col("n") * (ROUND_SHARE * 4**turn), F.lit(float(ROUND_WORDS) * 4**turn))
        following = F.min("octave").over(Window.partitionBy("lang"))
        chosen = ahead.withColumn("following", following).filter((F.col("so_far") <= budget) | (F.col("octave") == F.col("following")))
        chosen = written(chosen.select("lang", "octave"), "grown-octaves")
        growing = not chosen.isEmpty()
        if growing:
            heads = written(frequent.join(chosen, ["lang", "octave"], "left_semi"), "grown-words")
            new = grow(texts, heads, frequent_words, least)
            grown = new if grown is None else grown.unionByName(new)
        elif grown is None or (turn and not open_phrases):
            break
        known = frequent.select("lang", "phrase", "f").unionByName(grown.select("lang", "phrase", F.col("a").alias("f")))
        none = grown.select("lang", "phrase", F.col("a").alias("f"), F.lit(None).cast("boolean").alias("framed")).limit(0)
        seen = none if seen is None else seen
        counted = known.unionByName(seen.drop("framed")).groupBy("lang", "phrase").agg(F.max("f").alias("f"))
        now = written(scored(grown, counted, seen), "bounds")
        wanted, open_phrases = _to_count(now, top)
        if open_phrases:
            found = written(look_up(texts, wanted), "counted")
            seen = written(seen.unionByName(found), "counted-so-far")
            counted = known.unionByName(seen.drop("framed")).groupBy("lang", "phrase").agg(F.max("f").alias("f"))
            now = written(scored(grown, counted, seen), "scores")
        rows = now.filter("whole and not framed")
        last = ranked(rows, top).filter(F.col("rank") == top).select("lang", F.col("score").alias("settled_score"))
        reached = octaves.select("lang").distinct().join(chosen.groupBy("lang").agg(F.max("octave").alias("to")), "lang", "left")
        edges = edges.select("lang", "edge").join(reached, "lang").join(last, "lang", "left")
        edges = written(edges.select("lang", F.coalesce("to", "edge").alias("edge"), "settled_score"), "edges")
    if rows is None:
        rows = words.limit(0).selectExpr(
            "lang", "phrase", "1L as size", "f as a", "f as l", "f as r", "f as n", "f as score"
        )
    return ranked(rows, top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _to_count(now: DataFrame, top: int) -> tuple[DataFrame, bool]:
    """The phrases to look up next, themselves and their rests, and whether there are any.

    Of each language those that may reach its result: at most the octaves of bounds down to
    where AHEAD times as many phrases as asked for come first, and none below its settled score.
    """
    octave = F.floor(F.log2(F.col("score") + 1)).cast("int")
    rows = now.withColumn("octave", octave)
    sure = ranked(rows.filter("whole and not framed"), top).filter(F.col("rank") == top)
    sure = sure.select("lang", F.col("score").alias("settled_score"))
    falling = Window.partitionBy("lang").orderBy(F.desc("octave")).rowsBetween(Window.unboundedPreceding, -1)
    may_count = ~F.coalesce(F.col("framed"), F.lit(False))
    levels = rows.filter(may_count).groupBy("lang", "octave").agg(F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("whole")).alias("open"))
    levels = levels.withColumn("better", F.coalesce(F.sum("rows").over(falling), F.lit(0)))
    first_open = F.max(F.when(F.col("open") > 0, F.col("octave"))).over(Window.partitionBy("lang"))
    levels = levels.withColumn("first_open", first_open)
    levels = levels.filter((F.col("better") < AHEAD * top) | (F.col("octave") == F.col("first_open"))).select("lang", "octave")
    open_rows = rows.filter(may_count & ~F.col("whole")).join(levels, ["lang", "octave"], "left_semi").join(sure, "lang", "left")
    open_rows = open_rows.filter("settled_score is null or score >= settled_score")
    rests = F.transform(F.sequence(F.lit(0), F.col("size").cast("int") - 2), lambda cut: _rest(cut))
    wanted = open_rows.select("lang", F.explode(rests).alias("phrase"))
    wanted = written(wanted.filter(F.size(F.split("phrase", " ")) < LONGEST).distinct(), "wanted")
    return wanted, not wanted.isEmpty()


def _rest(cut: Column) -> Column:
    words = F.split("phrase", " ")
    return F.array_join(F.slice(words, cut + 1, F.size(words)), " ")

"""Collocations against a count of all phrases."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from test_operators import empty_docs, odd_docs

from tarmac.llm import collocations

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def by_counting(rows, least: int, top: int) -> list[tuple]:
    f, n = Counter(), Counter()
    for r in rows:
        lang = "und" if r.lang is None else r.lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (r.text or "").translate(LOWER)):
            words = tuple(re.findall("[^\x20\x09]+", piece))
            n[lang] += len(words)
            f.update((lang, words[i : i + m]) for m in range(1, 6) for i in range(len(words) - m + 1))
    found = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    dropped = {
        (lang, q[i : i + m]) for (lang, q), a in found.items() for m in range(2, len(q)) for i in range(len(q) - m + 1)
        if a >= f[lang, q[i : i + m]]
    }
    by_lang = defaultdict(list)
    for (lang, q), a in found.items():
        if (lang, q) not in dropped:
            cuts = [(f[lang, q[:k]], f[lang, q[k:]]) for k in range(1, len(q))]
            score, k = min((1000 * a * n[lang] // (left * right), k) for k, (left, right) in enumerate(cuts))
            by_lang[lang].append((-score, -a, " ".join(q).encode(), *cuts[k]))
    return sorted(
        (lang, rank, q.decode(), -a, left, right, n[lang], -score)
        for lang, rows in by_lang.items()
        for rank, (score, a, q, left, right) in enumerate(sorted(rows)[:top], 1)
    )


def same(docs, least: int, top: int) -> int:
    got = sorted(map(tuple, collocations.mine(docs, least=least, top=top).collect()))
    assert got == by_counting(docs.collect(), least, top)
    return len(got)


def made_up(seed: int, n_docs: int) -> list[tuple]:
    """Texts over few words with set phrases, signs, capitals and two languages that share words."""
    rng = random.Random(seed)
    sayings = [" ".join(rng.choice("abcdefghijklmnopqrst") * 2 for _ in range(rng.randrange(2, 8))) for _ in range(12)]
    rows = []
    for i in range(n_docs):
        parts = [rng.choice(sayings) if rng.random() < 0.4 else rng.choice("ABCDEfghijü") for _ in range(rng.randrange(60))]
        text = "".join(p + rng.choice([" ", " ", "\t ", ", ", ".\n"]) for p in parts)
        rows.append((i, text, rng.choice(["en", "de", None, "und"]), "x", "y"))
    return rows


@pytest.mark.parametrize(("first_round", "top"), [(1 << 22, 2000), (300, 5), (40, 60)])
def test_all_phrases_are_settled(spark, monkeypatch, first_round, top):
    monkeypatch.setattr(collocations, "ROUND_WORDS", first_round)
    docs = spark.createDataFrame(made_up(5, 150), "doc_id long, text string, lang string, phrase string, f string")
    assert same(docs.repartition(5), 12, top) > 10


def test_odd_rows_and_ties(spark):
    same(odd_docs(spark), 2, 3)
    rows = [(i, "one two three. four five six! a a a a a a", "en") for i in range(7)] + [(9, "x y", "de")] * 3
    same(spark.createDataFrame(rows, "doc_id long, text string, lang string"), 3, 4)


def test_an_empty_table_has_no_rows(spark):
    assert collocations.mine(empty_docs(spark)).collect() == []
    assert collocations.mine(odd_docs(spark), least=10**6).collect() == []


def test_products_beyond_64_bits(spark):
    known = spark.createDataFrame([("en", "a", 10**12), ("en", "b", 3 * 10**11)], "lang string, phrase string, f long")
    grown = spark.createDataFrame([("en", "a b", 2, 7 * 10**10, 10**14)], "lang string, phrase string, size long, a long, n long")
    seen = spark.createDataFrame([], "lang string, phrase string, framed boolean")
    row = collocations.scored(grown, known, seen).first()
    assert row.score == 1000 * 7 * 10**10 * 10**14 // (10**12 * 3 * 10**11)

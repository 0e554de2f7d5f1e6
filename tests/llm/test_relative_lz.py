"""Removal of repeated passages against a count of all windows."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from test_operators import empty_docs, odd_docs

from tarmac.llm import queries, relative_lz

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


def by_counting(rows, window: int) -> list[tuple]:
    texts = [WORD.findall(r.text or "") for r in rows]
    seen = Counter(tuple(words[i : i + window]) for words in texts for i in range(len(words) - window + 1))
    result = []
    for r, words in zip(rows, texts, strict=True):
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            if seen[tuple(words[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        result.append((r.doc_id, len(words), sum(gone), " ".join(w for w, g in zip(words, gone, strict=True) if not g)))
    return sorted(result, key=str)


def same(docs, window: int, filter_bits: int = 27) -> None:
    got = relative_lz.without_copies(docs, window, filter_bits=filter_bits)
    assert set(docs.columns) <= set(got.columns)
    rows = [tuple(r) for r in got.select("doc_id", "n_words", "n_removed", "kept_text").collect()]
    assert sorted(rows, key=str) == by_counting(docs.collect(), window)


def patchwork(seed: int, n_docs: int, letters: str) -> list[tuple]:
    """Documents put together from random words and passages of each other, some repeated whole."""
    rng = random.Random(seed)
    texts: list[list[str]] = []
    for _ in range(n_docs):
        words: list[str] = []
        for _ in range(rng.randrange(6)):
            if texts and rng.random() < 0.5:
                source = rng.choice(texts)
                at = rng.randrange(len(source) + 1)
                words += source[at : at + rng.randrange(40)]
            else:
                words += [rng.choice(letters) for _ in range(rng.randrange(30))]
        texts.append(words)
    texts += [texts[3]] * 20
    return [(i, rng.choice([" ", "\n\t", "  "]).join(words), "x") for i, words in enumerate(texts)]


@pytest.mark.parametrize(("window", "letters", "bits"), [(5, "abcdefghijklmnopqrstuvwxyzé", 27), (12, "ab", 27), (12, "abcdef", 6)])
def test_patchwork_matches_a_count_of_windows(spark, window, letters, bits):
    docs = spark.createDataFrame(patchwork(window, 120, letters), "doc_id long, text string, first string")
    same(docs.repartition(7), window, bits)


def test_odd_rows(spark):
    for window in (1, 2, 35):
        same(odd_docs(spark), window)


def test_repeated_rows_with_one_id_or_none_remove_each_other(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [(1, passage), (1, passage), (None, "other " + passage), (None, None), (2, passage[:-1]), (3, "é " * 34), (4, "é " * 35)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as key_a", "2 as n_words", "3 as rest", "4 as pieces")
    same(docs, 35)


def test_an_empty_table(spark):
    assert relative_lz.without_copies(empty_docs(spark)).collect() == []


def test_factors_name_where_their_words_stand(spark):
    rows = patchwork(1, 60, "abcdefghij")
    got = relative_lz.without_copies(spark.createDataFrame(rows, "doc_id long, text string, own string"), 6)
    names = relative_lz._keyed(got, "doc_id", "text").select("key_a", "text").collect()
    text_of = {r.key_a: WORD.findall(r.text) for r in names}
    checked = 0
    for r in got.collect():
        words = WORD.findall(r.text)
        for f in r.factors:
            assert f.words >= 6
            if f.reference is not None:
                assert words[f.start : f.start + f.words] == text_of[f.reference][f.reference_start : f.reference_start + f.words]
                checked += 1
    assert checked > 20


def test_query_over_a_whole_table(spark):
    import hashlib

    got = queries.op12_substring_dedup(spark, SF)
    want = by_counting(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect(), 35)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(i, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for i, n, gone, kept in want], key=str
    )

"""The Merkle manifest against trees built by plain loops."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from test_operators import empty_docs, odd_docs

from tarmac.llm import merkle


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, more: int = 0) -> str:
    values = [row.doc_id, row.source, row.lang, None if row.n_chars is None else row.n_chars + more, row.text]
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def plain_tree(leaves: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """Root and each leaf's siblings, left and right of it, from the leaf up."""
    paths, places, nodes = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(nodes) > 1:
        for i, at in enumerate(places):
            pair = nodes[at - at % 2 : at - at % 2 + 2]
            paths[i].append(("".join(pair[: at % 2]), "".join(pair[at % 2 + 1 :])))
            places[i] = at // 2
        nodes = [h(*nodes[j : j + 2]) for j in range(0, len(nodes), 2)]
    return nodes[0], paths


def plain_manifest(rows) -> list[tuple]:
    trees = {}
    for r in rows:
        trees.setdefault(r.lang, []).append((r.doc_id is not None, r.doc_id or 0, leaf(r), r))
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {}
    for name in names:
        trees[name].sort(key=lambda x: x[:3])
        built[name] = plain_tree([x[2] for x in trees[name]])
    root, tops = plain_tree([built[name][0] for name in names])
    result = []
    for top, name in zip(tops, names, strict=True):
        subroot, paths = built[name]
        for (_, _, own, r), path in zip(trees[name], paths, strict=True):
            path = path + top
            folded = leaf(r, 1) if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0 else own
            for left, right in path:
                folded = h(left, folded, right)
            result.append((r.doc_id, own, subroot, root, h(*[a + b for a, b in path]), folded, folded == root))
    return sorted(result, key=str)


def same(docs) -> None:
    got = merkle.tamper_manifest(docs)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=str) == plain_manifest(docs.collect())


def test_odd_rows_match_plain_trees(spark):
    same(odd_docs(spark))


def test_repeated_rows_names_and_hidden_columns(spark):
    rows = [(i // 3, f"t{i // 3}", [None, "", "é", "z", "en"][i // 3 % 5], "s", 2**63 - 1) for i in range(60)]
    rows += [(1, "a", "en", None, None)] * 9
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("tree", "digest", "rank", "level", "path", "key", "copy"):
        docs = docs.selectExpr("*", f"'x' as {name}")
    same(docs)


def test_an_empty_table_has_no_rows(spark):
    assert merkle.tamper_manifest(empty_docs(spark)).collect() == []


@pytest.mark.parametrize("rows", [1, 2, 3])
def test_small_trees(spark, rows):
    same(spark.range(rows).selectExpr("id as doc_id", "'x' as text", "'en' as lang", "'s' as source", "id as n_chars"))


def test_trees_above_one_block_and_several_bands(spark, monkeypatch):
    docs = spark.range(1500).selectExpr(
        "id * 7 % 1501 as doc_id", "repeat('x ', cast(id % 50 as int)) as text", "if(id % 9 = 0, 'de', 'en') as lang",
        "'s' as source", "id as n_chars",
    )
    same(docs)
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", 3)
    monkeypatch.setattr(merkle, "BAND_LEVELS", 2)
    same(docs)


def test_nodes_nest_and_siblings_fill_their_parent(spark):
    leaves = spark.range(21).selectExpr("' a' as tree", "id as rank", "21L as leaves", "sha2(cast(id as string), 256) as digest")
    nodes = merkle.tree_nodes(leaves)
    spans = {(r.level, r.lo): r.hi for r in nodes.collect()}
    assert spans[(5, 0)] == 21 and spans[(4, 16)] == 21 and spans[(2, 20)] == 21 and len(spans) == 21 + 11 + 6 + 3 + 2 + 1
    beside = {(r.level, r.lo): (r.left is not None, r.right is not None) for r in merkle.siblings(nodes).collect()}
    assert beside[(0, 20)] == (False, False) and beside[(0, 3)] == (True, False) and beside[(4, 0)] == (False, True)

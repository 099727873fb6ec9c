from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from lodestar.llm import merkle as M
from tests.llm.common import edge_docs, edge_rows, no_docs


def h(text):
    return sha256(text.encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(doc_id, text, lang, source, n_chars):
    return h("".join(map(field, (doc_id, source, lang, n_chars, text))))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][k:k + 2])) for k in range(0, len(out[-1]), 2)])
    return out


def siblings(tree, at):
    out = []
    for level in tree[:-1]:
        if at ^ 1 < len(level):
            out.append((at & 1, level[at ^ 1]))
        else:
            out.append(None)
        at >>= 1
    return out


def reference(rows):
    """Sorted (doc_id, leaf, subroot, root, proof_sha256) by plain lists."""
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(*r), r[0]))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: levels([e[2] for e in sorted(by_lang[x], key=lambda e: e[:3])]) for x in langs}
    forest = levels([trees[x][-1][0] for x in langs])
    out = []
    for k, x in enumerate(langs):
        for at, e in enumerate(sorted(by_lang[x], key=lambda e: e[:3])):
            path = siblings(trees[x], at) + siblings(forest, k)
            out.append((e[3], e[2], trees[x][-1][0], forest[-1][0], h("".join(s[1] for s in path if s))))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r["id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("levels_", range(1, 12))
def test_addresses_fill_the_block(levels_):
    at = [int(M.address(levels_, d, i)) for d in range(levels_) for i in range(1 << d)]
    assert sorted(at) == list(range((1 << levels_) - 1))
    if levels_ > 1:  # the top tree is one run at the front
        top = levels_ // 2
        assert sorted(at[:(1 << top) - 1]) == list(range((1 << top) - 1))


@pytest.mark.parametrize("m", [1, 2, 3, 5, 8, 13, 255, 256])
def test_stored_nodes_give_root_and_paths(m):
    leaves = [h(str(i)) for i in range(m)]
    n_levels = (m - 1).bit_length() + 1
    nodes, root = M.build(leaves, n_levels)
    tree = levels(leaves)
    assert root == tree[-1][0]
    for at, path in enumerate(M.steps(nodes, m, n_levels)):
        assert M.proof_text(path) == "".join(s[1] for s in siblings(tree, at) if s)
        assert M.fold(leaves[at], path) == root
        assert M.fold(h("other"), path) != root or m == 0


def test_edge_rows(spark):
    out = M.manifest(edge_docs(spark))
    assert rows_of(out) == reference(edge_rows())
    assert out.where("NOT verified").count() == 0


def test_many_blocks_and_languages(spark):
    """A tree over several levels of blocks, and more languages than a block holds."""
    rows = [(i, f"t{i % 7}", "en", None, i) for i in range(66_100)] + [(i, "x", f"l{i}", "s", None) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert rows_of(M.manifest(docs)) == reference(rows)


def test_tampered_rows_do_not_verify(spark):
    rows = [(i, "t", "en" if i % 3 else None, "s", None if i % 10 == 0 else i) for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    hit = F.col("doc_id") % 5 == 0
    out = M.manifest(docs, tampered={"n_chars": F.when(hit, F.col("n_chars") + 1).otherwise(F.col("n_chars"))})
    assert {r["id"] for r in out.where("NOT verified").collect()} == {i for i in range(700) if i % 5 == 0 and i % 10}
    assert {r[1] for r in rows_of(out)} == {leaf(*r) for r in rows}
    assert out.where("verified <> (folded_root = root)").count() == 0


def test_empty(spark):
    assert M.manifest(no_docs(spark)).count() == 0

"""The manifest against a tree built in plain Python."""

import hashlib
import zlib

import pytest

from pricelens.llm import merkle
from pricelens.llm.queries import QUERIES


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc_id, source, lang, n_chars, text):
    values = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return h("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i : i + 3]) for i in range(0, len(last), 3)])
    return levels


def path(levels, i):
    """(siblings before, siblings after) of each level."""
    found = []
    for nodes in levels[:-1]:
        run = i - i % 3
        found.append((nodes[run:i], nodes[i + 1 : run + 3]))
        i //= 3
    return found


def expected(rows):
    by_source = {}
    for r in rows:
        by_source.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf_of(*r), r))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(by_source[s], key=lambda x: x[:3])]) for s in order}
    top = tree([trees[s][-1][0] for s in order]) if order else None
    out = []
    for at, s in enumerate(order):
        for i, (_, _, leaf, r) in enumerate(sorted(by_source[s], key=lambda x: x[:3])):
            steps = path(trees[s], i) + path(top, at)
            text = r[4]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and text is not None:
                text = text.replace("\n", "")
            folded = leaf_of(*r[:4], text)
            for left, right in steps:
                folded = h(*left, folded, *right)
            proof = h(*[x for left, right in steps for x in (*left, *right)])
            root = top[-1][0]
            out.append((r[0], leaf, trees[s][-1][0], root, proof, folded, folded == root))
    return sorted(out, key=str)


NAMES = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def found(df):
    assert df.columns == NAMES
    return sorted((tuple(r) for r in df.collect()), key=str)


def table(spark, rows):
    return spark.createDataFrame(
        [(*r, "x", 1) for r in rows], "doc_id long, source string, lang string, n_chars long, text string, tree string, n int"
    ).repartition(3)


def test_whole_tables(spark, small_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{small_dir}/documents.parquet").select(*merkle.FIELDS).collect()]
    assert found(QUERIES["op13_merkle"](spark, small_dir)) == expected(rows)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 9, 10, 28])
def test_sizes_of_a_tree(spark, n):
    rows = [(i * 7, "a", "en", 1, f"text\n{i}") for i in range(n)]
    assert found(merkle.manifest(table(spark, rows))) == expected(rows)


def test_several_slot_arrays_deep(spark, monkeypatch):
    """Arrays of nine slots, so that three rounds and many sources are needed."""
    monkeypatch.setattr(merkle, "DEPTH", 2)
    monkeypatch.setattr(merkle, "WIDTH", 9)
    rows = [(i * i - 50, "hot" if i % 3 else f"s{i % 31}", "en", i, f"a\n{i}") for i in range(400)]
    assert found(merkle.manifest(table(spark, rows))) == expected(rows)


def test_nulls_ties_and_wide_ids(spark):
    rows = [
        (None, None, None, None, None), (None, None, None, None, None), (None, None, "en", 1, "x\n"), (5, None, None, None, ""),
        (5, None, None, None, ""), (5, None, "en", 0, "y\ny"), (6, None, "en", 0, "é\n"), (69, None, "en", 0, "z"), (70000, None, "de", 3, "a"),
        (-1, "", "en", 1, "a\nb"), (-2**62, "", "en", 1, "a\nb"), (2**62, "", "en", 1, "a\nb"), (63, "=", "en", 1, "q"), (64, "=", "en", 1, "q"),
        (7, "é", "en", 1, "long " * 50_000), (8, "z", "-", -1, "-"),
    ]
    rows += [(9, "many", "en", i % 4, "same\ntext") for i in range(60)]
    assert found(merkle.manifest(table(spark, rows))) == expected(rows)

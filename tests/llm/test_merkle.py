"""Merkle manifest against a plain one in memory."""

import hashlib
import zlib

import pytest
from pyspark.sql import types as T

from sluicebox.llm import merkle

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that the operator uses itself
    T.StructField("lo", T.StringType()), T.StructField("tree", T.IntegerType()), T.StructField("digest", T.StringType()),
])


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def coded(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(row, text):
    return H(*[coded(v) for v in (row[0], row[3], row[2], row[4], text)])


def lower(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def climb(nodes, fanout):
    """Root, and of each leaf its siblings before and after it by level."""
    paths, owners = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, up_owners = [], []
        for k in range(0, len(nodes), fanout):
            run = nodes[k : k + fanout]
            for j in range(len(run)):
                for i in owners[k + j]:
                    paths[i].append((run[:j], run[j + 1 :]))
            up.append(H(*run))
            up_owners.append([i for o in owners[k : k + fanout] for i in o])
        nodes, owners = up, up_owners
    return nodes[0], paths


def expected(rows, fanout=16):
    groups = {}
    for row in rows:
        groups.setdefault(row[3], []).append((row[0] is not None, row[0] or 0, leaf_of(row, row[1]), row))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda entry: entry[:3])
        trees[name] = climb([entry[2] for entry in groups[name]], fanout)
    root, tops = climb([trees[name][0] for name in names], fanout)
    out = []
    for name, top in zip(names, tops):
        for (_, _, leaf, row), path in zip(groups[name], trees[name][1]):
            path = path + top
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            node = leaf_of(row, lower(row[1])) if tampered else leaf
            for before, after in path:
                node = H(*before, node, *after)
            proof = H(*[d for before, after in path for d in before + after])
            out.append((row[0], leaf, trees[name][0], root, proof, node, node == root))
    return sorted(out, key=str)


def got(spark, rows, **options):
    df = merkle.verify(spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA), **options)
    assert df.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, df.collect()), key=str)


def docs(sizes):
    rows, i = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            i += 1
            rows.append((i * 7919 % 100_003, f"Text {i} of Größe Ä" * (i % 3), "en" if i % 2 else None, source, i))
    return rows


@pytest.mark.parametrize("sizes,fanout", [
    ({"a": 1}, 16), ({"a": 16, "b": 17, None: 1, "B": 300}, 16), ({"a": 40, "é": 3, "z": 1, "": 9}, 2),
    ({f"s{i}": 1 + i % 4 for i in range(20)}, 3),
], ids=["one row", "uneven sources", "pairs", "many sources"])
def test_against_plain_tree(spark, sizes, fanout):
    rows = docs(sizes)
    assert got(spark, rows, fanout=fanout) == expected(rows, fanout)


def test_nulls_repeats_and_long_texts(spark):
    rows = docs({"a": 5}) + [
        (None, "no id", "en", "a", 1), (None, None, None, None, None), (8, None, "en", "a", 0), (8, "Same id", "en", "a", 0),
        (8, "Same id", "en", "a", 0), (9, "", "", "", 0), (10, "ABC " * 400_000, "de", "a", 2),
    ]
    assert got(spark, rows) == expected(rows)


def test_changed_texts_fail_and_others_verify(spark):
    rows = [(i, "Capital" if i % 2 else "small", "en", f"s{i % 3}", 1) for i in range(400)]
    for doc_id, *_, verified in got(spark, rows):
        assert verified == (not (doc_id % 2 and zlib.crc32(str(doc_id).encode()) % 5 == 0))


def test_empty_table_and_manifest(spark):
    assert got(spark, []) == []
    empty = merkle.manifest(spark.createDataFrame([], SCHEMA))
    assert empty.root() is None
    rows = docs({"a": 20, "b": 2})
    made = merkle.manifest(spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA))
    assert made.root() == expected(rows)[0][3]
    assert sorted(tuple(r) for r in made.groups.collect()) == [(0, "a"), (1, "b")]
    # every node covers what its children cover, without gaps
    for node in made.levels[1].collect():
        bounds = [(c["lo"], c["hi"]) for c in node["children"]]
        assert bounds[0][0] == node["lo"] and bounds[-1][1] == node["hi"]
        assert all(a[1] + 1 == b[0] for a, b in zip(bounds, bounds[1:]))

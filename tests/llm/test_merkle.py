import hashlib
import zlib

import pytest

from pyspark.sql import functions as F

from tablewright.llm import merkle

SF_MID = "/root/testdata/sf0.01"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(r, more=0):
    n = None if r.n_chars is None else r.n_chars + more
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r.doc_id, r.source, r.lang, n, r.text)))


def up(nodes, fanout):
    """Levels from ``nodes`` to one node."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i:i + fanout])) for i in range(0, len(levels[-1]), fanout)])
    return levels


def walk(levels, at, node, fanout):
    """Siblings of a leaf and the top with ``node`` in its place, every parent hashed whole."""
    siblings = []
    for level in levels[:-1]:
        first = at - at % fanout
        run = level[first:first + fanout]
        siblings += run[:at - first] + run[at - first + 1:]
        run[at - first] = node
        node, at = sha("".join(run)), at // fanout
    return siblings, node


def brute(rows, fanout=2):
    groups = {}
    for r in rows:
        groups.setdefault((r.lang is not None, (r.lang or "").encode()), []).append(r)
    trees = {g: sorted(some, key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf_of(r))) for g, some in sorted(groups.items())}
    built = {g: up([leaf_of(r) for r in some], fanout) for g, some in trees.items()}
    top = up([b[-1][0] for b in built.values()], fanout)
    out = []
    for k, (g, some) in enumerate(trees.items()):
        for i, r in enumerate(some):
            changed = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0
            siblings, node = walk(built[g], i, leaf_of(r, int(changed)), fanout)
            more, node = walk(top, k, node, fanout)
            out.append((r.doc_id, leaf_of(r), built[g][-1][0], top[-1][0], sha("".join(siblings + more)), node, node == top[-1][0]))
    return sorted(out, key=repr)


def found(docs, fanout=2):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    tree = merkle.manifest(merkle.document_leaves(docs, tampered), ["doc_id", "digest", "row"], fanout)
    return sorted((tuple(r) for r in merkle.verify(tree, ["doc_id"], "replacement").collect()), key=repr)


def test_whole_table(spark):
    rows = spark.read.parquet(f"{SF_MID}/documents.parquet").collect()
    got = merkle.op13_merkle(spark, SF_MID)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)


def test_edge_rows(spark, docs):
    docs = docs.selectExpr("*", "7 g", "8 pos", "9 n", "'y' digest", "'z' row", "'w' replacement", "1 part", "'v' leaf")
    assert found(docs) == brute(docs.collect())
    assert found(docs.limit(0)) == []
    one = docs.where("doc_id = 4")
    assert found(one) == brute(one.collect())


@pytest.mark.parametrize("fanout", [2, 3, 5])
def test_several_rounds(spark, monkeypatch, fanout):
    """Groups of one leaf, of a part of a chunk, of whole chunks and of several rounds; more groups than a chunk."""
    monkeypatch.setattr(merkle, "CHUNK", 8 if fanout == 2 else 9)
    sizes = [1, 2, 7, 8, 9, 64, 65, 130, *[3] * 12]
    rows = [(1000 * g + i, f"text {i % 5}", None if g == 0 else f"l{g}ä", "s", None if i % 4 == 0 else i) for g, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(7)
    got = found(df, fanout)
    assert got == brute(df.collect(), fanout) and {True, False} == {r[-1] for r in got}


def test_states_are_resumed_to_the_right():
    """A fold reads the state before its slot and the siblings to the right; those to the left aren't needed."""
    nodes = [sha(str(i)) for i in range(5)]
    whole, states = merkle.parent(nodes)
    assert whole == sha("".join(nodes)) and len(states) == 5
    for slot in range(5):
        assert merkle.resumed(states[slot], nodes[slot], nodes[slot + 1:]) == whole
        assert merkle.resumed(states[slot], sha("x"), nodes[slot + 1:]) == sha("".join([*nodes[:slot], sha("x"), *nodes[slot + 1:]]))

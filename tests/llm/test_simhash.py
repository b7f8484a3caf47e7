import re

import pytest
import xxhash

from tablewright.llm import simhash

SF_MID = "/root/testdata/sf0.01"


def brute(rows):
    fps = []
    for doc_id, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        fps.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    low = {}
    for i, (doc_id, _) in enumerate(rows):
        k = find(i)
        if doc_id is not None:
            low[k] = min(low.get(k, doc_id), doc_id)
    key = lambda r: [(x is None, x) for x in r]
    return sorted(((doc_id, f"{fps[i]:016x}", low.get(find(i))) for i, (doc_id, _) in enumerate(rows)), key=key)


def found(df):
    rows = simhash.near_duplicates(df).collect()
    key = lambda r: [(x is None, x) for x in r]
    return sorted(((r.doc_id, f"{r.fp & (1 << 64) - 1:016x}", r.component_id) for r in rows), key=key)


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()]
    assert sorted(map(tuple, simhash.op2_simhash(spark, SF_MID).collect())) == brute(rows)


def test_edge_rows(spark, docs):
    assert found(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    classes = {c for _, _, c in found(docs)}
    assert kept.count() == len(classes)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    nameless = spark.createDataFrame([(None, "one text that stands alone"), (None, "another one, quite unlike it"), (None, None)],
                                     "doc_id long, text string")
    assert simhash.one_of_each(nameless.unionByName(nameless)).count() == 3


@pytest.mark.parametrize("most", [1, 3, 130])
def test_links_of_a_crowd(spark, monkeypatch, most):
    """Chains and crowds of close fingerprints: paired or by shared neighbours, the components are those of all pairs."""
    import random

    monkeypatch.setattr(simhash, "MOST_PAIRED", most)
    rnd = random.Random(5)
    fps = {0, 2**63, 2**64 - 1}
    for _ in range(12):
        x = rnd.getrandbits(64)
        for _ in range(25):
            fps.add(x)
            for _ in range(rnd.choice([1, 2, 3])):
                x ^= 1 << rnd.randrange(64)
    fps = sorted(fps)
    df = spark.createDataFrame([(simhash._signed(x),) for x in fps], "fp long")
    from tablewright.llm.common import components

    got = {r.node: r.root for r in components(simhash.links(df)).collect()}
    root = {x: {x} for x in fps}
    for a in fps:
        for b in fps:
            if a < b and (a ^ b).bit_count() <= 2 and root[a] is not root[b]:
                both = root[a] | root[b]
                for x in both:
                    root[x] = both
    for x in fps:
        s = simhash._signed(x)
        assert got.get(s, s) == min(map(simhash._signed, root[x]))


def test_columns_of_any_name_stay(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, "a b c"), (None, None)], "doc_id long, text string")
    df = df.selectExpr("*", "3 _id", "4 _hash", "7 _n", "'r' row", "5 k", "6 root", "8 fp", "9 text_hash", "1 component_id")
    got = simhash.one_of_each(df)
    assert got.columns == df.columns
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted([(1, "a b c", 3, 4, 7, "r", 5, 6, 8, 9, 1), (None, None, 3, 4, 7, "r", 5, 6, 8, 9, 1)], key=repr)

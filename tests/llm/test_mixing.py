import math
import random
import re
from collections import Counter, defaultdict

import pytest

from tablewright.llm import mixing

SF_MID = "/root/testdata/sf0.01"


def targets(sizes):
    """Capped water-filling by plain loops."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    left, free, out = float(sum(sizes.values())), set(names), {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * level > 3 * sizes[s]]
        for s in over or list(free):
            out[s] = 3.0 * sizes[s] if over else weight[s] * level
            left -= out[s] if over else 0
            free.discard(s)
    return out


def check(rows, texts):
    sizes, taken = defaultdict(int), defaultdict(int)
    for (doc_id, text, source), r in zip(texts, rows):
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want = targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, want[r.source], rel_tol=1e-12)
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= 1
    return want


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    source = {r.doc_id: (r.doc_id, r.text, r.source) for r in docs.collect()}
    got = mixing.op6_mixing(spark, SF_MID).collect()
    named = mixing.mix(docs.withColumn("size", mixing.word_count(docs["text"])).select("doc_id", "source", "size")).collect()
    check(named, [source[r.doc_id] for r in named])
    assert sorted(map(tuple, got)) == sorted((r.doc_id, r.size, r.source_size, r.target, r.taken) for r in named)


def test_edge_rows_and_texts(spark, docs):
    d = docs.drop("size").withColumn("size", mixing.word_count(docs["text"]))
    rows = mixing.mix(d).collect()
    check(rows, [(r.doc_id, r.text, r.source) for r in rows])
    mixed = mixing.mixed_documents(docs.withColumn("taken", docs["doc_id"]))
    assert mixed.columns == [*docs.columns, "taken"] and all(r.size == 1 and r.taken == r.doc_id for r in mixed.collect())
    words = sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in mixed.collect())
    assert words == sum(r.taken for r in mixing.mix(d, parts=False).collect())


def test_rerun_and_empty(spark, docs):
    d = docs.drop("size").withColumn("size", mixing.word_count(docs["text"]))
    key = lambda r: repr(tuple(r))
    assert sorted(mixing.mix(d).collect(), key=key) == sorted(mixing.mix(d.repartition(5)).collect(), key=key)
    assert mixing.mix(d.limit(0)).count() == 0


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 1, "c": 1}, {"a": 1, "b": 5, "c": 10**6, None: 4}, {"a": 0}])
def test_targets(spark, sizes):
    df = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    want = targets(sizes)
    assert all(math.isclose(got[s], want[s], rel_tol=1e-12) for s in sizes)


def test_every_text_of_the_mix_is_whole(spark):
    """No prefix: the document at a source's edge is taken whole or not, whichever is nearer to the target."""
    rng = random.Random(5)
    rows = [(k, " \n\n" + "".join(f"wörd{i}{' ' * (i % 3 + 1)}\t" for i in range(rng.randrange(1, 400))), s)
            for k, s in enumerate("a" * 40 + "b" * 90 + "c" * 300 + "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 n_chars", "2 whole", "3 edge", "4 time")
    got = mixing.mixed_documents(df)
    assert got.columns == df.columns
    texts, sizes, taken, times = dict((k, t) for k, t, _ in rows), Counter(), Counter(), Counter()
    for k, t, s in rows:
        sizes[s] += len(t.split())
    for r in got.collect():
        assert r.text == texts[r.doc_id] and (r.n_chars, r.whole, r.edge, r.time) == (1, 2, 3, 4)
        taken[r.source] += len(r.text.split())
        times[r.doc_id] += 1
    largest = {s: max(len(t.split()) for _, t, x in rows if x == s) for s in sizes}
    assert all(abs(taken[s] - t) <= largest[s] / 2 + 1 for s, t in targets(sizes).items()) and max(times.values()) <= 3

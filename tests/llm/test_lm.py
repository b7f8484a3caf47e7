import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tablewright.llm import lm

SF_MID = "/root/testdata/sf0.01"


def toks(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + ["\n"]


def base(rows):
    held = {r.doc_id: r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 2 for r in rows}
    c = Counter(t for r in rows if not held[r.doc_id] for t in toks(r.text))
    n, v = sum(c.values()), len(c)
    return [(r.doc_id, held[r.doc_id], len(toks(r.text)), sum(c[t] > 0 for t in toks(r.text)), n,
             sum(math.log10((c[t] + 1) / (n + v + 1)) for t in toks(r.text))) for r in rows]


def check(got, want):
    key = lambda r: repr(r[:4])
    for g, w in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True):
        assert g[:5] == w[:5] and math.isclose(g[5], w[5], rel_tol=1e-9)
        assert -1e9 < g[6] < 0


@pytest.mark.parametrize("head", [lm.HEAD, 200])
def test_whole_table(spark, monkeypatch, head):
    monkeypatch.setattr(lm, "HEAD", head)
    rows = spark.read.parquet(f"{SF_MID}/documents.parquet").collect()
    got = lm.op5_lm(spark, SF_MID).collect()
    check(got, base(rows))
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) * 0.97  # log-probabilities: at most as far below 0


def test_edge_rows(spark, docs):
    check(lm.score(docs).collect(), base(docs.collect()))
    assert lm.score(docs.limit(0)).count() == 0
    alone = lm.score(docs.where("doc_id = 5")).collect()
    assert len(alone) == 1 and alone[0].n_tokens == 1


def test_class_probabilities_sum_to_one_and_training_helps():
    rng = np.random.default_rng(0)
    move = rng.dirichlet(np.full(40, 0.05), 40)
    ids = [0, 1]
    for _ in range(60000):
        ids.append(int(rng.choice(40, p=move[ids[-1]])))
    ids = np.array(ids)
    frequency = np.bincount(ids, minlength=lm.CLASSES) + 1e-3
    frequency = frequency / frequency.sum()
    context = lm.contexts(ids, 0)
    code, n = np.unique(context * lm.CLASSES + ids, return_counts=True)
    model = lm.fresh(frequency)
    square = {k: np.full_like(v, 1e-6) for k, v in model.items()}
    score = lambda: lm.log_probabilities(model)[context, ids].mean()
    before = score()
    for k in range(6):
        lm.train_pass(model, square, code, n.astype(float), frequency, k)
    assert np.allclose(np.exp(lm.log_probabilities(model).astype(float)).sum(1), 1, atol=1e-4)
    assert score() > before + 0.5


def test_score_is_that_of_the_model(spark, monkeypatch):
    """Every text's score again, token by token: the softmax over all classes after its context, then the count within the class."""
    kept = {}
    plain_trained, plain_triples = lm.trained, lm.triple_counts
    monkeypatch.setattr(lm, "trained", lambda *a, **b: kept.setdefault("model", plain_trained(*a, **b)))
    monkeypatch.setattr(lm, "triple_counts", lambda docs, classes, *a: (kept.setdefault("classes", classes), plain_triples(docs, classes, *a))[1])
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.collect()
    got = {r.doc_id: r.score for r in lm.score(docs).collect()}
    model, classes = kept["model"], kept["classes"]
    c = Counter(t.encode() for r in rows if zlib.crc32(str(r.doc_id).encode()) % 7 != 2 for t in toks(r.text))
    of = lambda t: int(classes.of([t])[0])
    mass = Counter({k: 1 for k in range(lm.CLASSES) if k < len(classes.own) + len(classes.starts) or k == lm.CLASSES - 1})
    for t, n in c.items():
        mass[of(t)] += n + (of(t) >= len(classes.own))
    unused = [k for k in range(lm.CLASSES) if k not in mass]
    for r in rows[:60]:
        two = one = of(lm.END)
        total = 0.0
        for t in (t.encode() for t in toks(r.text)):
            s = (model["r"][two] * model["w"][0] + model["r"][one] * model["w"][1]) @ model["q"].T + model["b"]
            s[unused] = -np.inf
            k = of(t)
            total += (s[k] - s.max() - np.log(np.exp(s - s.max()).sum())) / np.log(10)
            if k >= len(classes.own):
                total += math.log10((c[t] + 1) / mass[k])
            two, one = one, k
        assert math.isclose(got[r.doc_id], total, rel_tol=1e-4), r.doc_id


def test_reruns_agree_whatever_the_partitions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    scores = []
    for n, size in ((1, "10000"), (7, "37")):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            scores.append({r.doc_id: r.score for r in lm.score(docs.repartition(n)).collect()})
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert scores[0].keys() == scores[1].keys() and all(math.isclose(scores[0][k], scores[1][k], rel_tol=1e-9) for k in scores[0])

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tablewright.llm import suffix

SF_MID = "/root/testdata/sf0.01"


def brute(rows, length):
    """doc_id, bytes, removed, spans, digest by counting every string of ``length`` bytes."""
    n = Counter()
    for _, raw in rows:
        n.update(raw[i:i + length] for i in range(len(raw) - length + 1))
    out = []
    for doc_id, raw in rows:
        cover = np.zeros(len(raw) + 1, np.int64)
        for i in range(len(raw) - length + 1):
            if n[raw[i:i + length]] > 1:
                cover[i] += 1
                cover[i + length] -= 1
        gone = np.cumsum(cover)[:-1] > 0
        spans = int(np.sum(np.diff(np.concatenate([[0], gone.astype(int)])) == 1))
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes() if raw else b""
        out.append((doc_id, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def encoded(rows):
    return [(r.doc_id, (r.text or "").encode()) for r in rows]


@pytest.mark.parametrize("crowd", [256, 3])
def test_whole_table(spark, monkeypatch, crowd):
    monkeypatch.setattr(suffix, "CROWD", crowd)
    rows = spark.read.parquet(f"{SF_MID}/documents.parquet").collect()
    got = sorted(map(tuple, suffix.op3_suffix(spark, SF_MID).collect()), key=repr)
    assert got == brute(encoded(rows), 200)


def test_edge_rows(spark, docs, tmp_path, monkeypatch):
    monkeypatch.setattr(suffix, "CROWD", 2)
    monkeypatch.setattr(suffix, "BLOCK", 300)
    rnd = random.Random(4)
    passage = "".join(rnd.choice("abcé ñ日") for _ in range(260))
    noise = lambda k: "".join(rnd.choice("pqrstuvwxyz ") for _ in range(k))
    rows = [(30 + k, noise(rnd.randrange(90)) + passage[rnd.randrange(4):260 - rnd.randrange(4)] + noise(rnd.randrange(90)))
            for k in range(9)] + [(50, "ab" * 400), (51, noise(500) + passage + passage)]
    every = docs.unionByName(spark.createDataFrame([(i, t, "en", "s", len(t), "", 1) for i, t in rows], docs.schema))
    every.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, suffix.op3_suffix(spark, str(tmp_path)).collect()), key=repr)
    assert got == brute(encoded(every.collect()), 200)
    every = every.withColumnRenamed("fp", "spans")
    left = suffix.deduplicated(every)
    assert left.columns == every.columns
    texts = {r.doc_id: r.text for r in left.collect()}
    assert texts[4] is None and texts[8] == "" and texts[7] == "one" and passage[20:200] not in texts[30]
    assert all(r.n_chars == len(r.text) for r in left.collect() if r.text is not None)
    assert suffix.remove_spans(docs.limit(0), suffix.repeated_spans(docs.limit(0))).count() == 0


def test_runs_partition_the_starts():
    rnd = random.Random(6)
    text = bytes(rnd.choice(b"ab") for _ in range(2000))
    key, start, n, anchor = suffix.runs(text, 50, 16)
    assert start[0] == 0 and np.array_equal(start[1:], start[:-1] + n[:-1]) and start[-1] + n[-1] == 2000 - 50 + 1
    assert np.all((anchor >= start + n - 1) & (anchor + 16 <= start + 50))
    assert suffix.runs(b"x" * 49, 50, 16)[0].size == 0

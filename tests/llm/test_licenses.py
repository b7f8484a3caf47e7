import re

from tablewright.llm import licenses

SF_MID = "/root/testdata/sf0.01"


def words_of(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def base(text):
    w, places, labels = words_of(text), [], set()
    for label, phrase in licenses.PHRASES:
        p = phrase.split()
        at = [i for i in range(len(w)) if w[i:i + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def digest(spark, df, path):
    df.write.parquet(path + "/documents.parquet")
    return licenses.op9_licenses(spark, path).collect()


def test_whole_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()}
    got = licenses.op9_licenses(spark, SF_MID).collect()
    assert sorted(tuple(r)[:6] for r in got) == sorted((i, *base(t)) for i, t in texts.items())
    for r in got:
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert r.score == 1.0 if r.n_base else 0 <= r.score < 1 and bool(r.score) == bool(r.labels)


def test_edge_rows_and_notices(spark, docs, tmp_path):
    notice = dict(licenses.NOTICES)["bsd"]
    edited = notice.replace("source and binary", "source or in binary").replace("must retain", "shall retain")
    broken = " filler ".join(notice.split())
    rows = [(100, "Some code. " + notice.upper() + "\nmore", "bsd"), (101, edited, "bsd"), (102, broken, ""),
            (103, "CC BY-NC, cc by nc; Under the\nMIT License! under the mit license " * 3, "cc-by-nc,mit"),
            (104, " ".join(notice.split()[:12]), ""), (105, "Apache License, Version 2.0 " + notice, "apache-2,bsd")]
    more = spark.createDataFrame([(i, t, "en", "s", len(t), "", 1) for i, t, _ in rows], docs.schema)
    every = docs.unionByName(more)
    got = digest(spark, every, str(tmp_path / "t"))
    key = lambda r: repr(r)
    assert sorted((tuple(r)[:6] for r in got), key=key) == sorted(((r.doc_id, *base(r.text)) for r in every.collect()), key=key)
    labels = {r.doc_id: r.labels for r in got}
    assert {i: labels[i] for i, _, _ in rows} == {i: x for i, _, x in rows}
    assert len(got) == every.count()


def test_empty(spark, docs):
    assert licenses.scan(docs.limit(0)).count() == 0

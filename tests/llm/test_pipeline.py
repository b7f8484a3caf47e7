import hashlib
import re

import corpus_pipeline as pipeline

import test_bpe
import test_mixing
import test_quality
import test_simhash
import test_suffix

SF = "/root/testdata/sf0.001"
key = repr


def cut(raw, texts):
    """The text without repeated bytes, from the set of all 200-byte strings that occur twice."""
    gone = [False] * len(raw)
    for i in range(len(raw) - 199):
        if texts[raw[i:i + 200]] > 1:
            gone[i:i + 200] = [True] * 200
    out, piece = "", b""
    for b, g in [*zip(raw, gone), (0, True)]:
        if g:
            out, piece = out + piece.decode(errors="ignore"), b""
        else:
            piece += bytes([b])
    return out


def test_each_stage_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {}
    for k, (name, stage) in enumerate(pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(f"{tmp_path}/{k}")
        kept[name] = (docs.collect(), spark.read.parquet(f"{tmp_path}/{k}").collect())
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        assert k == len(pipeline.STAGES) - 1 or docs.columns == columns

    rows, got = kept["quality_rules"]
    good = test_quality.verdicts(rows)[2]
    assert sorted(got, key=key) == sorted((r for r, g in zip(rows, good) if g), key=key) and len(got) < len(rows)

    rows, got = kept["simhash_near_dedup"]
    first = {c for _, _, c in test_simhash.brute([(r.doc_id, r.text) for r in rows])}
    assert sorted(got, key=key) == sorted((r for r in rows if r.doc_id in first), key=key) and len(got) < len(rows)

    rows, got = kept["suffix_array_dedup"]
    strings = test_suffix.Counter()
    for r in rows:
        raw = r.text.encode()
        strings.update(raw[i:i + 200] for i in range(len(raw) - 199))
    want = {r.doc_id: cut(r.text.encode(), strings) for r in rows}
    assert {r.doc_id: r.text for r in got} == want and all(r.n_chars == len(r.text) for r in got)
    assert sum(map(len, want.values())) < sum(r.n_chars for r in rows)

    rows, got = kept["mixing"]
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes, taken, per = {}, {}, {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + count(r.text)
    for r in got:
        taken[r.source] = taken.get(r.source, 0) + count(r.text)
        per[r.doc_id] = per.get(r.doc_id, 0) + count(r.text)
    largest = {s: max(count(r.text) for r in rows if r.source == s) for s in sizes}
    assert all(abs(taken.get(s, 0) - t) <= largest[s] / 2 + 1 for s, t in test_mixing.targets(sizes).items())
    texts = {(r.doc_id, r.text) for r in rows}
    assert all((r.doc_id, r.text) in texts for r in got)  # whole texts only
    assert all(per.get(r.doc_id, 0) <= 3 * count(r.text) for r in rows)

    rows, got = kept["bpe"]
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = [(r.doc_id, len(i.split()), sha(i), sha(d)) for r, (i, d) in zip(rows, test_bpe.library([r.text for r in rows]))]
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert sorted(map(tuple, pipeline.run(spark, SF).collect())) == sorted(want)

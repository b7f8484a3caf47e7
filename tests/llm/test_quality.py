import re
from collections import Counter, defaultdict

import numpy as np

from tablewright.llm import quality

SF_MID = "/root/testdata/sf0.01"


def stats(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    wins = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    n = Counter(wins)
    covered = {i + k for i, x in enumerate(wins) if n[x] > 1 for k in range(5)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))


def vector(s):
    n = s[0] + 30
    v = [4 * np.log((s[1] + 150) / n), np.log1p(20 * s[2] / n), np.log1p(20 * s[3] / n), np.log1p(5 * s[4] / n)]
    return [float(np.floor(1000 * x + 0.5)) for x in v]


def least(values, share):
    values = sorted(values)
    return values[int(np.ceil(share * len(values))) - 1]


def squared(x, m, low):
    return (np.linalg.solve(low, (x - m).T) ** 2).sum(0)


def steps(d):
    return np.floor(16 * np.log2(d + 1e-6))


def estimate(x, held=None, starts=(0, 1, 2)):
    """Least determinant's logarithm, its start, location and triangular factor: half held, until no determinant falls."""
    n, floor = len(x), 100.0 ** 2 * np.eye(4)
    held = held or (n + 4 + 1) // 2
    mid = np.array([least(c, 0.5) for c in x.T])
    dev = np.array([least(np.abs(c - m), 0.5) for c, m in zip(x.T, mid)])
    first = {0: (mid, np.diag((1.4826 * dev) ** 2) + floor), 1: (mid, floor), 2: (x.mean(0), np.cov(x.T, bias=True) + floor)}
    found = []
    for start in starts:
        (m, cov), before = first[start], np.inf
        while True:
            d = steps(squared(x, m, np.linalg.cholesky(cov)))
            some = x[d <= sorted(d)[held - 1]]
            m, cov = some.mean(0), np.cov(some.T, bias=True) + floor
            det = 2 * np.log(np.diag(np.linalg.cholesky(cov))).sum()
            found.append((det, start, m, np.linalg.cholesky(cov)))
            if not det < before - 1e-4:
                break
            before = det
    return min(found, key=lambda f: f[:2])


def cell_verdicts(x, cutoff=None, **options):
    """Which rows of a cell are near enough: the cutoff follows the distances of the clean ones."""
    _, _, m, low = estimate(x, **options)
    d = squared(x, m, low)
    scale = max(1.0, 2 ** ((least(steps(d), 0.5) + 0.5) / 16) / 3.3567)
    clean = steps(d[d <= 18.467 * scale])
    far = max(18.467, 5 * 2 ** ((least(clean, 0.99) + 1) / 16) / scale) if len(clean) else 18.467
    return d / scale <= (cutoff or far)


def verdicts(rows):
    """The whole operator in numpy, cell by cell."""
    s = [stats(r.text) for r in rows]
    base = [x[0] < 10 or 100 * x[4] > 20 * x[0] for x in s]
    count = Counter((r.lang, r.source) for r, b in zip(rows, base) if not b)
    small = Counter()
    for (lang, source), n in count.items():
        small[lang] += n if n < 60 else 0
    cells = defaultdict(list)
    for i, r in enumerate(rows):
        if not base[i]:
            k = (r.lang, r.source)
            cells[(0, *k) if count[k] >= 60 else (1, r.lang) if small[r.lang] >= 60 else (2,)].append(i)
    kept = [not b for b in base]
    for members in cells.values():
        if len(members) >= 60:
            for i, near in zip(members, cell_verdicts(np.array([vector(s[i]) for i in members]))):
                kept[i] = bool(near)
    return s, base, kept


def test_whole_table(spark):
    rows = sorted(spark.read.parquet(f"{SF_MID}/documents.parquet").collect(), key=lambda r: r.doc_id)
    s, base, kept = verdicts(rows)
    got = sorted(quality.op1_quality(spark, SF_MID).collect(), key=lambda r: r.doc_id)
    assert [tuple(r)[:8] for r in got] == [(r.doc_id, *x, b, k) for r, x, b, k in zip(rows, s, base, kept)]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    good = [r for r in got if labels.get(r.doc_id) == 1 and not r.base_failed]
    bad = [r for r in got if labels.get(r.doc_id) == 0]
    assert all(r.kept for r in good) and sum(r.kept for r in bad) < 0.1 * len(bad)


def test_edge_rows(spark, docs):
    again = "a b c d e f g h i j\na b c d e f g h i j\n\n \t\n" * 40
    junk = docs.limit(1).selectExpr("20L doc_id", f"'{again}' text", "lang", "source", "n_chars", "fp", "size")
    every = docs.unionByName(junk)
    key = lambda r: repr(r)
    rows = every.collect()
    got = sorted((tuple(r) for r in quality.judge(every).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                                               "n_repeat_words", "base_failed", "kept").collect()), key=key)
    s, base, kept = verdicts(rows)
    assert got == sorted(((r.doc_id, *x, b, k) for r, x, b, k in zip(rows, s, base, kept)), key=key)
    left = quality.kept_documents(every)
    assert left.columns == every.columns and left.count() == sum(kept)
    assert quality.judge(docs.limit(0)).count() == 0


def test_a_third_of_a_cell_is_one_copied_outlier(spark):
    """Copies that pass the base rules don't pull the estimate to themselves; the others stay."""
    rng = np.random.default_rng(4)
    usual = [" ".join("".join(rng.choice(list("abcdefghij"), rng.integers(2, 9))) for _ in range(rng.integers(80, 300)))
             for _ in range(200)]
    junk = " ".join(f"#*w{k}*#" for k in range(200))
    data = [(i, t, "en", "a") for i, t in enumerate(usual + [junk] * 100)]
    got = {r.doc_id: r for r in quality.judge(spark.createDataFrame(data, "doc_id long, text string, lang string, source string")).collect()}
    assert not any(r.base_failed for r in got.values())
    assert all(got[i].kept for i in range(200)) and not any(got[i].kept for i in range(200, 300))


def mixture(rng):
    """Vectors with two thirds of a cell in the middle, a third at one far point and some in between."""
    x = np.concatenate([rng.normal(0, 150, (260, 4)) * [1, 2, 1, 3], rng.normal(0, 20, (130, 4)) + [900, -700, 800, 2500],
                        rng.normal(0, 1200, (30, 4))])
    return np.round(x).astype(int)


def test_estimate_holds_half_from_three_starts(spark):
    """The operator's estimate is that of least determinant; with more held, other starts or another cutoff it is another."""
    rng = np.random.default_rng(12)
    cells = {k: mixture(rng) for k in range(6)}
    cells[6] = np.round(np.concatenate([rng.normal(0, 100, (100, 4)), rng.normal(3000, 30, (99, 4))])).astype(int)
    df = spark.createDataFrame([(k, *map(int, row)) for k, x in cells.items() for row in x], "cell long, v0 long, v1 long, v2 long, v3 long")
    got = {r.cell: r for r in quality._concentrated(df).collect()}
    starts, differ = set(), Counter()
    for k, x in cells.items():
        det, start, m, low = estimate(x.astype(float))
        starts.add(start)
        assert abs(sum(2 * np.log(got[k][f"l{i}{i}"]) for i in range(4)) - det) < 1e-6
        assert np.allclose([got[k][f"m{i}"] for i in range(4)], m) and np.allclose(got[k]["l30"], low[3, 0])
        differ["held"] += abs(estimate(x.astype(float), held=int(0.75 * len(x)))[0] - det) > 1e-3
        differ["starts"] += any(abs(estimate(x.astype(float), starts=(s,))[0] - det) > 1e-3 for s in (0, 1, 2))
        differ["cutoff"] += (cell_verdicts(x.astype(float)) != cell_verdicts(x.astype(float), cutoff=100.0)).any()
    assert differ["held"] == 7 and differ["starts"] and differ["cutoff"]


def test_columns_of_any_name_stay(spark):
    text = " ".join(f"word{k}" for k in range(40))
    df = spark.createDataFrame([(1, text, "en", "a"), (2, "x", "en", "a")], "doc_id long, text string, lang string, source string")
    df = df.selectExpr("*", "7 _h", "8 _l", "9 _s", "'r' row", "'t' text_hash", "1 cell", "2 kept", "3 v0")
    assert [tuple(r) for r in quality.kept_documents(df).collect()] == [(1, text, "en", "a", 7, 8, 9, "r", "t", 1, 2, 3)]
    assert quality.kept_documents(df).columns == df.columns

import math
import re
from functools import lru_cache

from tablewright.llm import trie_tokens

SF_MID = "/root/testdata/sf0.01"
PIECES, BYTE = trie_tokens.unigram()


@lru_cache(None)
def word(w):
    """Best segmentation of one word by a plain table, no sharing."""
    t = "▁" + w
    best = [(0, 0, 0)]
    for j in range(1, len(t) + 1):
        n = len(t[j - 1].encode())
        every = [(best[j - 1][0] + n * BYTE, best[j - 1][1] - n, best[j - 1][2] - n)]
        every += [(best[i][0] + PIECES[t[i:j]], best[i][1] - 1, best[i][2]) for i in range(j) if t[i:j] in PIECES]
        best.append(max(every))
    return best[-1]


def brute(text):
    found = [word(w) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    return len(found), -sum(f[1] for f in found), -sum(f[2] for f in found), sum(f[0] for f in found)


def test_whole_table(spark):
    rows = spark.read.parquet(f"{SF_MID}/documents.parquet").collect()
    assert sorted(map(tuple, trie_tokens.op4_trie_tokens(spark, SF_MID).collect())) == sorted((r.doc_id, *brute(r.text)) for r in rows)


def test_edge_rows(spark, docs):
    key = lambda r: repr(r)
    got = sorted(map(tuple, trie_tokens.count_tokens(docs).collect()), key=key)
    assert got == sorted(((r.doc_id, *brute(r.text)) for r in docs.collect()), key=key)
    assert trie_tokens.count_tokens(docs.limit(0)).count() == 0


def test_scores_agree_with_the_library():
    from tokenizers import Tokenizer, models

    t = Tokenizer(models.Unigram([(p, s / 1e6) for p, s in PIECES.items()], None, False))
    trie = trie_tokens.Trie(PIECES, BYTE)
    for w in ["the", "tokenization", "internationale", "thinonnd", "erschließung", "aaaaaaaaaaaaaaaaaaaaaaaa", "über-all", "x"]:
        score, n, alone = trie.insert(w.encode())
        ids = t.encode("▁" + w).ids
        assert alone == 0 and math.isclose(score / 1e6, sum(PIECES[t.id_to_token(i)] for i in ids) / 1e6, abs_tol=1e-6)
        assert n <= len(ids)


def test_sharing_and_clearing(monkeypatch):
    trie = trie_tokens.Trie(PIECES, BYTE)
    trie.insert(b"international")
    before = len(trie.best)
    trie.insert(b"internationally")
    assert len(trie.best) == before + 2
    again = trie.insert("日本ñ".encode())
    trie.clear()
    assert trie.insert("日本ñ".encode()) == again

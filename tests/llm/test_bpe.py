import gc
import hashlib
import random

from tablewright.llm import bpe

SF_MID = "/root/testdata/sf0.01"


def library(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(bpe.vocabulary_text())
    t.no_truncation()
    t.no_padding()
    out = []
    for x in texts:
        ids = t.encode(x or "", add_special_tokens=False).ids
        out.append((" ".join(map(str, ids)), t.decode(ids, skip_special_tokens=False)))
    return out


def test_whole_table(spark):
    rows = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text").collect()
    want = sorted((r.doc_id, len(i.split()), hashlib.sha256(i.encode()).hexdigest(), hashlib.sha256(d.encode()).hexdigest())
                  for r, (i, d) in zip(rows, library([r.text for r in rows])))
    assert sorted(map(tuple, bpe.op10_bpe(spark, SF_MID).collect())) == want


def test_edge_rows(spark, docs):
    rows = docs.collect()
    want = sorted((str(r.doc_id), i, d) for r, (i, d) in zip(rows, library([r.text for r in rows])))
    assert sorted((str(r.doc_id), r.ids, r.decoded) for r in bpe.encode(docs).collect()) == want
    assert bpe.encode(docs.limit(0)).count() == 0


def test_any_text_at_any_cut(monkeypatch):
    """Random texts with marks, odd spaces, special tokens and long runs, with cuts so dense that they fall into words and characters."""
    monkeypatch.setattr(bpe, "MOST_WORDS", 200)
    monkeypatch.setattr(bpe, "MOST_CHUNK_BYTES", 2000)
    rnd = random.Random(3)
    bits = ["a", "B", "é", "é", "́", " ", "\n", "\t", "\x0b", "\x85", "\xa0", "　", "\x1c", "'s", "'LL", "12", "٣",
            "<|endoftext|>", "<|startoftext|>", "日本", "Σ", "ς", "İ", "ß", "🙂", "‍", "!!", "__", "한", "가", "\x00"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randrange(400))) for _ in range(150)] + ["x" * 5000, " " * 999, "é" * 3000]
    monkeypatch.setattr(bpe.chunks, "__defaults__", (3, 4))
    e = bpe.Encoder(bpe.vocabulary_text())
    for at in range(0, len(texts), 10):
        some = texts[at:at + 10]
        ids, decoded = e.run([t.encode() for t in some])
        assert [(i.decode(), d.decode()) for i, d in zip(ids, decoded)] == library(some)


def test_chunks_are_shared():
    rnd = random.Random(1)
    text = " ".join("".join(rnd.choice("abcdef") for _ in range(6)) for _ in range(4000)).encode()
    a, b = bpe.chunks(text), bpe.chunks(b"another start " + text)
    assert b"".join(a) == text and len(set(a) & set(b)) > 0.8 * len(a)


def test_words_are_decoded_by_the_batch():
    e = bpe.Encoder(bpe.vocabulary_text())
    plain, calls = e.tokenizer, []

    class Counted:
        def __getattr__(self, name):
            calls.append(name)
            return getattr(plain, name)

    e.tokenizer = Counted()
    texts = ["one two's, three <|endoftext|> \x00 four " * 3, "", "\u65e5\u672c x12 \u00e9 one"]
    ids, decoded = e.run([t.encode() for t in texts])
    assert [(i.decode(), d.decode()) for i, d in zip(ids, decoded)] == library(texts)
    assert calls == ["encode_batch_fast", "decode_batch"]


def test_a_full_memory_keeps_the_frequent_words(monkeypatch):
    monkeypatch.setattr(bpe, "MOST_WORDS", 300)
    e = bpe.Encoder(bpe.vocabulary_text())
    learned, plain = [], e.learn
    monkeypatch.setattr(e, "learn", lambda words: (learned.append(set(words)), plain(words))[1])
    often = [f"often{i}x" for i in range(50)]
    for step in range(12):
        text = " ".join(often + [f"once{step}n{i}" for i in range(80)] + often)
        ids, decoded = e.run([text.encode()])
        assert [(i.decode(), d.decode()) for i, d in zip(ids, decoded)] == library([text])
    assert not any(w.decode() in often for words in learned[1:] for w in words) and len(e.ids) <= 300 + 130
    assert gc.isenabled()

"""BPE encoding and decoding with content-defined chunk reuse.

A text is cut where a hash rolling over its bytes says so, wherever that
falls, so equal passages of different documents are cut alike inside.  Each
chunk is encoded once and its encoding reused by every document of the worker
that holds it.  A chunk knows only its whole words for sure: the pieces of words at its two
ends are held back, and at each join the held-back pieces are put together and
encoded anew, reaching over further chunks until a space on either side closes
the window.  There the encoding agrees with that of the whole text, because
the tokenizer's merges, its pre-tokens and its composed characters never
reach over a space, so the result is exact for any cut.

Words repeat far more than chunks, so the library encodes each distinct word
once as well.  Both memories are bounded and only save work: emptying them
changes no result.  A full memory of words keeps those of the texts at hand,
the frequent ones among them.

Defined results: a null or empty text has no tokens and decodes to an empty
text; repeated rows are encoded each; only the columns asked for are read.
"""

from __future__ import annotations

import gc
import hashlib
import os
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tablewright.llm.common import table

VOCABULARY = "word_bpe_49k.json"
#: Chunks have 2^9 bytes on average and at least MIN_CHUNK, but for the last.
CHUNK_BITS, MIN_CHUNK = 9, 64
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
#: Bounds of a worker's memories: words, bytes of chunks; bytes of text handled at a time.
MOST_WORDS, MOST_CHUNK_BYTES, STEP_BYTES = 400_000, 16 << 20, 4 << 20

_WHITE = frozenset(b" \t\n\r\x0b\x0c")
_encoders: dict[str, "Encoder"] = {}


def chunks(text: bytes, bits: int = CHUNK_BITS, least: int = MIN_CHUNK) -> list[bytes]:
    """``text`` in content-defined chunks."""
    if len(text) <= 2 * least:
        return [text] if text else []
    windows = np.ndarray((len(text) - 7,), "<u8", text, 0, (1,))
    cuts = np.flatnonzero((windows * MULTIPLIER) >> np.uint64(64 - bits) == 0) + 8
    out, start = [], 0
    for cut in cuts.tolist():
        if cut - start >= least:
            out.append(text[start:cut])
            start = cut
    if start < len(text):
        out.append(text[start:])
    return out


@contextmanager
def _no_collection():
    """A block that makes many small lists but no cycles: the collector would only walk over them."""
    before = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if before:
            gc.enable()


class Encoder:
    """Encodes and decodes with one vocabulary, remembering chunks and words."""

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        if self.tokenizer.decoder is not None:
            raise ValueError("texts of decoded words can be joined only if the vocabulary has no decoder of its own")
        # Ids in decimal, as many as the vocabulary's largest asks for.
        self.numbers = [b"%d" % i for i in range(max(self.tokenizer.get_vocab(with_added_tokens=True).values(), default=-1) + 1)]
        self.ids: dict[bytes, bytes] = {}  # of a word: decimal ids with spaces
        self.decoded: dict[bytes, bytes] = {}
        self.chunks: dict[bytes, tuple[bytes, bytes]] = {}
        self.chunk_bytes = 0

    def learn(self, words: list[bytes]) -> None:
        found = self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
        ids = [e.ids for e in found]
        del found
        number = self.numbers.__getitem__
        self.ids.update(zip(words, [b" ".join(map(number, x)) for x in ids]))
        decoded = self.tokenizer.decode_batch(ids, skip_special_tokens=False)
        self.decoded.update(zip(words, map(str.encode, decoded)))

    def run(self, texts: list[bytes | None]) -> tuple[list[bytes], list[bytes]]:
        """For each text its ids, in decimal with one space between, and its decoded text."""
        with _no_collection():
            return self._run(texts)

    def _run(self, texts: list[bytes | None]) -> tuple[list[bytes], list[bytes]]:
        plans, fresh, wanted = [], {}, set()
        for text in texts:
            plan, held = [], []  # (a word of its own, a chunk)
            for chunk in chunks(text) if text else ():
                words = chunk.split()
                if len(words) == 1 and len(words[0]) == len(chunk):  # no space yet: the window goes on
                    held.append(chunk)
                    continue
                if chunk[0] not in _WHITE:
                    held.append(words.pop(0))
                if held:
                    plan.append((b"".join(held), None))
                held = [words.pop()] if words and chunk[-1] not in _WHITE else []
                plan.append((None, chunk))
                if chunk not in self.chunks and chunk not in fresh:
                    fresh[chunk] = words
                    wanted.update(words)
            if held:
                plan.append((b"".join(held), None))
            wanted.update(w for w, _ in plan if w)
            plans.append(plan)
        self.learn([w for w in wanted if w not in self.ids])
        join = b" ".join
        for chunk, words in fresh.items():
            self.chunks[chunk] = (join(filter(None, map(self.ids.__getitem__, words))),
                                  join(filter(None, map(self.decoded.__getitem__, words))))
            self.chunk_bytes += len(chunk)
        ids = [join(filter(None, (self.ids[w] if w else self.chunks[c][0] for w, c in plan))) for plan in plans]
        decoded = [join(filter(None, (self.decoded[w] if w else self.chunks[c][1] for w, c in plan))) for plan in plans]
        if len(self.ids) > MOST_WORDS:
            few = wanted if len(wanted) <= MOST_WORDS // 2 else ()
            self.ids, self.decoded = ({w: d[w] for w in few} for d in (self.ids, self.decoded))
        if self.chunk_bytes > MOST_CHUNK_BYTES:
            self.chunks, self.chunk_bytes = {}, 0
        return ids, decoded


def _encoder(key: str, vocabulary: str) -> Encoder:
    if key not in _encoders:
        _encoders[key] = Encoder(vocabulary)
    return _encoders[key]


def vocabulary_text(path: str | None = None) -> str:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
           vocabulary: str | None = None) -> DataFrame:
    """The columns ``keep`` of every row with ``ids`` (decimal token ids with
    one space between) and ``decoded`` (the text that they decode to).

    ``vocabulary`` is a path on the driver; the file, a few MB for any input,
    is broadcast."""
    words = vocabulary_text(vocabulary)
    key, shared = hashlib.sha256(words.encode()).hexdigest(), docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(key, shared.value)
        for batch in batches:
            texts = batch.column(len(keep)).cast(pa.binary())
            sizes = np.cumsum([len(x.as_buffer()) if x.is_valid else 0 for x in texts])
            start = 0
            while start < len(sizes):
                before = sizes[start - 1] if start else 0
                end = max(start + 1, int(np.searchsorted(sizes, before + STEP_BYTES, "right")))
                ids, decoded = encoder.run(texts.slice(start, end - start).to_pylist())
                part = batch.slice(start, end - start)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in range(len(keep))), pa.array(ids, pa.binary()).cast(pa.string()),
                     pa.array(decoded, pa.binary()).cast(pa.string())], names=[*keep, "ids", "decoded"])
                start = end

    rows = docs.select(*keep, text)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]),
                        "ids string, decoded string"])
    return rows.mapInArrow(run, schema)


def digests(encoded: DataFrame) -> DataFrame:
    """``doc_id``, ``n_tokens`` and the SHA-256 of ids and decoded text."""
    n = F.when(F.col("ids") == "", 0).otherwise(F.length("ids") - F.length(F.translate("ids", " ", "")) + 1)
    return encoded.select("doc_id", n.cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(encode(table(spark, sf_dir, "documents").select("doc_id", "text")))


QUERIES = {"op10_bpe": op10_bpe}
SQL: dict[str, str] = {}

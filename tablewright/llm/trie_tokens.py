"""Token counts under a unigram model, with forward scores shared in a trie.

Each pre-token (a word with the mark of its beginning) is cut into the pieces
of a vocabulary whose scores sum highest.  The best score of a prefix doesn't
depend on what follows, so the distinct pre-tokens of a task are inserted in a
trie, each node computes the best score of its prefix once, whatever number of
pre-tokens pass through it, and the node where a pre-token ends holds its
count of pieces.  A node extends the pieces that its parent left open, by one step
in a trie of the pieces.  Documents add up the counts of their words.

The vocabulary is that of a public tokenizer; its pieces come in order of rank,
and a piece's score is the logarithm of ``1 / (rank + SHIFT)``, shared out over
all pieces, in whole millionths so that sums are exact.  What no piece covers
is read as bytes.  Of segmentations with equal scores the one with fewer pieces
counts, then the one with fewer bytes.

Defined results: a null or empty text has no words and no tokens; repeated rows
are counted each; an empty table gives an empty result.  The trie is emptied
when it has ``MOST_NODES`` nodes, which costs work but changes no result.
"""

from __future__ import annotations

import gc
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tablewright.llm.common import table

VOCABULARY = "piece_bpe_32k.model"
#: The mark before a word in the vocabulary (fixed value).
MARK = "▁"
SHIFT = 2.7
#: Added to the score of the rarest piece for each byte read alone, in millionths.
BYTE_PENALTY = -5_000_000
MOST_NODES = 600_000
#: Bits of the packed numbers of pieces and bytes: more than any text has.
FIELD = 40


def unigram(path: str | None = None) -> tuple[dict[str, int], int]:
    """The pieces with their scores, and the score of a byte, in millionths."""
    import sentencepiece

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.vocab_size())
             if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    norm = math.log(sum(1 / (r + SHIFT) for r in range(len(names))))
    pieces = {name: round(-1e6 * (math.log(r + SHIFT) + norm)) for r, name in enumerate(names)}
    return pieces, min(pieces.values()) + BYTE_PENALTY


def packed(score: int, pieces: int, alone: int) -> int:
    """One number that orders as (score, fewer pieces, fewer bytes) and adds up as they do."""
    return (score << 2 * FIELD) - (pieces << FIELD) - alone


def unpacked(total: int) -> tuple[int, int, int]:
    """Score, pieces and bytes among them of a sum of packed numbers."""
    low = (1 << FIELD) - 1
    return -(-total >> 2 * FIELD), -total >> FIELD & low, -total & low


class Trie:
    """Forward scores of all prefixes of the inserted words.

    The pieces are a trie of their own, walked along: a node knows the pieces that begin within its prefix and
    may go on (place in the trie of pieces, score up to their beginning), so a child extends those few instead
    of looking up all substrings that end in it."""

    def __init__(self, pieces: dict[str, int], byte: int):
        self.bytes = [packed(n * byte, n, n) for n in range(5)]
        self.pieces: dict = {}
        for name, score in pieces.items():
            at = self.pieces
            for c in name:
                at = at.setdefault(c, {})
            at[""] = packed(score, 1, 0)
        self.words: dict[bytes, int] = {}
        self.clear()

    def clear(self) -> None:
        self.children: list[dict[str, int]] = [{}]
        self.best: list[int] = [0]
        self.open: list[list[tuple[dict, int]]] = [[]]
        self.words.clear()

    def insert(self, word: bytes) -> tuple[int, int, int]:
        """The score, pieces and bytes among them of a word, from its node."""
        return unpacked(self.add(word))

    def add(self, word: bytes) -> int:
        children, node = self.children, 0
        for c in MARK + word.decode():
            child = children[node].get(c)
            node = self._child(node, c) if child is None else child
        found = self.words[word] = self.best[node]
        return found

    def _child(self, node: int, c: str) -> int:
        before, ahead = self.best[node], []
        best = before + self.bytes[1 if c < "\x80" else len(c.encode())]
        for piece, start in (*self.open[node], (self.pieces, before)):
            piece = piece.get(c)
            if piece is not None:
                ends = piece.get("")
                if ends is not None:
                    if start + ends > best:
                        best = start + ends
                    if len(piece) == 1:
                        continue
                ahead.append((piece, start))
        child = self.children[node][c] = len(self.best)
        self.children.append({})
        self.best.append(best)
        self.open.append(ahead)
        return child


_tries: dict[str | None, Trie] = {}


def count_tokens(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
                 vocabulary: str | None = None) -> DataFrame:
    """The columns ``keep`` of every row with ``n_words``, ``n_tokens``, ``n_bytes``
    (the tokens that are single bytes) and ``score`` (millionths, natural logarithm)."""
    shared = docs.sparkSession.sparkContext.broadcast(unigram(vocabulary))  # a vocabulary file's pieces
    names = [*keep, "n_words", "n_tokens", "n_bytes", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary not in _tries:
            _tries.clear()
            _tries[vocabulary] = Trie(*shared.value)
        trie = _tries[vocabulary]
        collects = gc.isenabled()
        gc.disable()  # the tries have no cycles, and looking for some in all their nodes costs more than they do
        try:
            for batch in batches:
                rows = []
                for value in batch.column(len(keep)).cast(pa.binary()):
                    words = value.as_buffer().to_pybytes().split() if value.is_valid else []
                    if len(trie.best) > MOST_NODES:
                        trie.clear()
                    for w in set(words).difference(trie.words):
                        trie.add(w)
                    score, pieces, alone = unpacked(sum(map(trie.words.__getitem__, words)))
                    rows.append((len(words), pieces, alone, score))
                columns = list(zip(*rows)) if rows else [()] * 4
                yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))),
                                                  *(pa.array(c, pa.int64()) for c in columns)], names=names)
        finally:
            if collects:
                gc.enable()

    rows = docs.select(*keep, text)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]),
                        "n_words long, n_tokens long, n_bytes long, score long"])
    return rows.mapInArrow(run, schema)


def op4_trie_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op4_trie_tokens": op4_trie_tokens}
SQL: dict[str, str] = {}

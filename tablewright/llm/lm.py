"""Language-model scores from a log-bilinear model trained by noise contrast.

The model predicts a token in two steps: its class from the two tokens before
it, by a log-bilinear network, and the token within its class by its count.
The commonest tokens are classes of their own; all others, and every token never
seen, fall into classes by their first two bytes.  A class has
``log p ~ (w1 * r[c1] + w2 * r[c2]) . q[t] + b[t]``; the parameters are trained
in numpy by noise-contrastive estimation against the classes' frequencies.
Since two tokens of context have ``CLASSES ** 2`` values, one batched matrix
product normalises the network for all of them, and a token's log-probability
is a lookup.  Within a class a token with count c has probability
``(c + 1) / (tokens + types + 1)``; the 1 left over is that of unseen tokens, so
the probabilities of all tokens sum to one.

Everything gathered covers the whole training part: token counts and counts of
class triples are grouped sums.  Training passes over all triples: each of
``PARTS`` parts takes a pass from the shared parameters, and the parts' results
are averaged, weighted by their tokens (``ROUNDS`` times).  Counts of the
``HEAD`` commonest tokens (at most so many) are broadcast, counts of the others
joined to the documents that hold them.

Defined results: a null or empty text is its end token alone; a null id is in
the training part; repeated rows are trained on and scored each; without any
training text all tokens are unseen; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tablewright.llm.common import discard, materialize, table

#: The end token: a character that no word has.
END = b"\n"
CLASSES, OWN, HEAD = 256, 128, 131_072
WIDTH, NOISE, BATCH, RATE, ROUNDS, SEED = 24, 32, 512, 0.15, 4, 3
STEP_TOKENS, STEP_TRIPLES = 400_000, 1 << 14
#: Parts that the triples are trained in; a fixed number, since the result depends on it.
PARTS = 8
#: Parameters are averaged as whole numbers of 1 / UNIT.
UNIT = 2.0 ** 32


def tokens(text: bytes | None) -> list[bytes]:
    words = text.lower().split() if text else []  # bytes: A-Z, and \x20\x09-\x0D
    words.append(END)
    return words


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


class Classes:
    """Tokens to classes: own classes for ``own`` tokens, else by first bytes, else the last class."""

    def __init__(self, own: list[bytes], starts: list[bytes]):
        self.own = {w: k for k, w in enumerate(own)}
        self.starts = {w: len(own) + k for k, w in enumerate(starts)}
        self.other = CLASSES - 1

    def of(self, words: list[bytes]) -> np.ndarray:
        own, starts, other = self.own, self.starts, self.other
        return np.fromiter((own[w] if w in own else starts.get(w[:2], other) for w in words), np.int64, len(words))


def contexts(ids: np.ndarray, end: int) -> np.ndarray:
    """The two classes before each token as one number; before the text stands its end token."""
    one = np.concatenate([[end], ids[:-1]])
    two = np.concatenate([[end, end], ids[:-2]])[:len(ids)]
    return two * CLASSES + one


# --- training ---------------------------------------------------------------


def fresh(frequency: np.ndarray) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return {"r": rng.standard_normal((CLASSES, WIDTH)) * 0.1, "q": rng.standard_normal((CLASSES, WIDTH)) * 0.1,
            "w": np.array([[0.5], [1.0]]) * np.ones((2, WIDTH)), "b": np.log(frequency)}


def _pack(model: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([model[k].ravel() for k in ("r", "q", "w", "b")])


def _unpack(flat: np.ndarray) -> dict[str, np.ndarray]:
    shapes, out, at = {"r": (CLASSES, WIDTH), "q": (CLASSES, WIDTH), "w": (2, WIDTH), "b": (CLASSES,)}, {}, 0
    for k, shape in shapes.items():
        out[k] = flat[at:at + int(np.prod(shape))].reshape(shape).copy()
        at += int(np.prod(shape))
    return out


def train_pass(model: dict[str, np.ndarray], square: dict[str, np.ndarray], code: np.ndarray, n: np.ndarray,
               frequency: np.ndarray, seed: int, rate: float = RATE) -> None:
    """One pass of noise-contrastive estimation over triples with counts, in
    random order; a triple with a large count is visited several times.
    ``square``: the sums of squared gradients that the steps are scaled by."""
    rng = np.random.default_rng([SEED, seed])
    times = np.ceil(n / max(1.0, n.mean())).astype(np.int64)
    rows = rng.permutation(np.repeat(np.arange(len(n)), times))
    weight = (n / times)[rows]
    weight /= weight.mean()
    target, context = code[rows] % CLASSES, code[rows] // CLASSES
    one, two = context % CLASSES, context // CLASSES
    shift = np.log(NOISE * frequency)
    some = rng.choice(CLASSES, (-(-len(rows) // BATCH), NOISE), p=frequency)
    for step, at in enumerate(range(0, len(rows), BATCH)):
        t, c1, c2, g = target[at:at + BATCH], one[at:at + BATCH], two[at:at + BATCH], weight[at:at + BATCH]
        noise = some[step]
        r1, r2, q, b, w = model["r"][c1], model["r"][c2], model["q"], model["b"], model["w"]
        h = r1 * w[1] + r2 * w[0]
        real = (h * q[t]).sum(1) + b[t] - shift[t]
        fake = h @ q[noise].T + b[noise] - shift[noise]
        up = g / (1 + np.exp(np.clip(real, -30, 30)))  # towards the real token
        down = -g[:, None] / (1 + np.exp(-np.clip(fake, -30, 30)))  # away from the noise
        dh = up[:, None] * q[t] + down @ q[noise]
        grad = {k: np.zeros_like(v) for k, v in model.items()}
        np.add.at(grad["q"], t, up[:, None] * h)
        np.add.at(grad["q"], noise, down.T @ h)
        np.add.at(grad["b"], t, up)
        np.add.at(grad["b"], noise, down.sum(0))
        np.add.at(grad["r"], c1, dh * w[1])
        np.add.at(grad["r"], c2, dh * w[0])
        grad["w"][1], grad["w"][0] = (dh * r1).sum(0), (dh * r2).sum(0)
        for k, v in grad.items():
            v /= len(t)
            square[k] += v * v
            model[k] += rate * v / np.sqrt(square[k] + 1e-8)


def trained(triples: DataFrame, frequency: np.ndarray, rounds: int = ROUNDS) -> dict[str, np.ndarray]:
    """The model after ``rounds`` passes over the written ``triples`` (code, n).

    They are dealt to ``PARTS`` parts by the hash of their code, sorted and passed over in a seeded order, and the
    parts' results are averaged in whole units: the model follows from the triples alone, on any cluster."""
    flat = _pack(fresh(frequency))
    half = len(flat)
    flat = np.concatenate([flat, np.full(half, 1e-6)])
    dealt = triples.repartition(PARTS, "code")
    for turn in range(rounds):
        def run(frames: Iterator[pd.DataFrame], start=flat, turn=turn) -> Iterator[pd.DataFrame]:
            from pyspark import TaskContext

            part = TaskContext.get().partitionId()
            model, square = _unpack(start[:half]), _unpack(start[half:])
            # At most CLASSES ** 3 / PARTS triples.
            mine = pd.concat(list(frames) or [pd.DataFrame({"code": [], "n": []})]).sort_values("code")
            code, n = mine["code"].to_numpy(np.int64), mine["n"].to_numpy(np.float64)
            order = np.random.default_rng([SEED, turn, part]).permutation(len(code))
            for k, at in enumerate(range(0, len(order), STEP_TRIPLES)):
                some = order[at:at + STEP_TRIPLES]
                train_pass(model, square, code[some], n[some], frequency, (turn * PARTS + part) * 100_000 + k, RATE)
            if len(order):
                whole = np.round(np.concatenate([_pack(model), _pack(square)]) * UNIT).astype(np.int64)
                yield pd.DataFrame({"k": np.arange(len(whole)), "x": whole, "n": int(n.sum())})

        # Whole numbers, so that their sums don't depend on the order of the parts; as many rows as the model has parameters.
        weighted = F.sum(F.col("x").cast("decimal(20,0)") * F.col("n").cast("decimal(17,0)"))
        found = dealt.mapInPandas(run, "k int, x long, n long").groupBy("k").agg(weighted.alias("x"), F.sum("n").alias("n")).collect()
        if found:
            flat = flat.copy()
            flat[[r.k for r in found]] = [float(r.x / r.n) / UNIT for r in found]
    return _unpack(flat[:half])


def log_probabilities(model: dict[str, np.ndarray]) -> np.ndarray:
    """Natural logarithms of the probabilities of all classes after every context: (contexts, classes)."""
    r, w = model["r"], model["w"]
    h = (r[:, None, :] * w[0] + r[None, :, :] * w[1]).reshape(-1, WIDTH).astype(np.float32)
    scores = np.empty((CLASSES ** 2, CLASSES), np.float32)
    q, b = model["q"].T.astype(np.float32), model["b"].astype(np.float32)
    for at in range(0, len(h), 4096):
        s = h[at:at + 4096] @ q + b
        s -= s.max(1, keepdims=True)
        scores[at:at + 4096] = s - np.log(np.exp(s).sum(1, keepdims=True))
    return scores


# --- corpus statistics --------------------------------------------------------


def _raw(batch: pa.RecordBatch, k: int) -> list[bytes | None]:
    return batch.column(k).cast(pa.binary()).to_pylist()


def token_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, c) over all texts of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.binary()), pa.array(found.values(), pa.int64())],
                                              names=["word", "c"])

        for batch in batches:
            for value in batch.column(0).cast(pa.binary()):
                found.update(tokens(value.as_buffer().to_pybytes() if value.is_valid else None))
                if len(found) > STEP_TOKENS:
                    yield out()
                    found.clear()
        if found:
            yield out()

    return docs.select(text).mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def triple_counts(docs: DataFrame, classes: Classes, text: str = "text") -> DataFrame:
    """(code, n) of all class triples in the texts of ``docs``."""
    end = int(classes.of([END])[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out():
            code, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(code), pa.array(n.astype(np.int64))], names=["code", "n"])

        for batch in batches:
            for value in batch.column(0).cast(pa.binary()):
                ids = classes.of(tokens(value.as_buffer().to_pybytes() if value.is_valid else None))
                held.append(contexts(ids, end) * CLASSES + ids)
                size += len(ids)
                if size > 2 * STEP_TOKENS:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    return docs.select(text).mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def commonest(vocabulary: DataFrame, most: int) -> DataFrame:
    """The words above a count that at most ``most`` words reach, found from the
    number of words by sixteenth of an octave of their count (some 1000 rows)."""
    step = F.floor(16 * F.log2("c"))
    total, cut = 0, None
    for r in sorted(vocabulary.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect(), key=lambda r: -r.step):
        total += r.n
        if total > most:
            break
        cut = r.step
    return vocabulary.where(step >= cut) if cut is not None else vocabulary.limit(0)


# --- the operator --------------------------------------------------------------

_tables: dict[str, tuple] = {}


def score(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every row's ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` and ``score`` (log10), learnt from the rows that aren't held out."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.col(text).alias("text"), held_out(F.col("doc_id")).alias("held_out"))
    training = rows.where("not held_out")
    vocabulary = materialize(token_counts(training), "vocabulary")
    total, types = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()

    # The commonest tokens (HEAD at most) and first bytes (CLASSES at most).
    head = sorted(((bytes(r.word), r.c) for r in commonest(vocabulary, HEAD).collect()), key=lambda x: (-x[1], x[0]))
    own = [END, *(w for w, _ in head[:OWN] if w != END)][:OWN]
    rest = vocabulary.join(F.broadcast(spark.createDataFrame([(bytearray(w),) for w in own], "word binary")), "word", "left_anti")
    by_start = rest.groupBy(F.substring("word", 1, 2).alias("start")).agg(F.sum("c").alias("c"), F.count("*").alias("types"))
    by_start = materialize(by_start, "starts")  # two bytes have 65,536 values
    found = by_start.orderBy(F.desc("c"), "start").limit(CLASSES - 1 - len(own)).collect()
    classes = Classes(own, [bytes(r.start) for r in found])
    mass = np.zeros(CLASSES)
    counts = dict(head)
    for k, w in enumerate(own):
        mass[k] = counts.get(w, 0) + 1  # one type, and no unseen ones
    for k, r in enumerate(found):
        mass[len(own) + k] = r.c + r.types + 1
    several = by_start.agg(F.coalesce(F.sum("c"), F.lit(0)), F.coalesce(F.sum("types"), F.lit(0))).first()
    mass[-1] = several[0] + several[1] - sum(r.c + r.types for r in found) + 1
    unused = mass == 0  # classes that no token can be of
    frequency = np.where(unused, 1e-12, mass) / mass.sum()
    frequency /= frequency.sum()

    triples = materialize(triple_counts(training, classes), "triples")
    model = trained(triples, frequency)
    discard(triples, by_start)
    model["b"] = np.where(unused, -1e4, model["b"])
    within = np.where(np.arange(CLASSES) < len(own), 0.0, np.log10(np.where(unused, 1, mass)))
    end = int(classes.of([END])[0])
    known = {w: k for k, (w, _) in enumerate(head)}
    shared = spark.sparkContext.broadcast((known, np.array([c for _, c in head], np.float64), classes, model, within))
    name = hashlib.sha256(_pack(model).tobytes() + repr(total).encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        known, counts, classes, model, within = shared.value
        if name not in _tables:
            _tables.clear()
            _tables[name] = (log_probabilities(model), np.log10(np.append(counts, 0) + 1))
        log_p, log_c = _tables[name]
        row = TaskContext.get().partitionId() << 33
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch, out = whole.slice(at, 1000), []
                for value in _raw(batch, 1):
                    words = tokens(value)
                    place = np.fromiter(map(known.get, words, repeat(-1)), np.int64, len(words))
                    ids = classes.of(words)
                    met = place >= 0
                    inner = log_c[place]
                    network = log_p[contexts(ids, end), ids].sum(dtype=np.float64) / np.log(10) - within[ids].sum()
                    shared_class = ids >= len(classes.own)
                    rare = Counter(w for w, m in zip(words, met.tolist()) if not m)
                    out.append((row, len(words), int(met.sum()), float(inner.sum()),
                                float(network + inner[shared_class].sum()), list(rare), list(rare.values())))
                    row += 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(2), *(pa.array(c, t) for c, t in zip(zip(*out), kinds))], names=names)

    kinds = [pa.int64()] * 3 + [pa.float64()] * 2 + [pa.list_(pa.binary()), pa.list_(pa.int64())]
    names = ["doc_id", "held_out", "row", "n_tokens", "met", "head_log", "class_log", "rare", "times"]
    scored = materialize(rows.mapInArrow(run, "doc_id long, held_out boolean, row long, n_tokens long, met long, head_log double, "
                                              "class_log double, rare array<binary>, times array<long>"), "scored")
    # Tokens that aren't among the commonest: their counts are joined. Unseen ones have log10(0 + 1) = 0.
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("t")).select(
        "row", F.col("t.rare").alias("word"), F.col("t.times").alias("times"))
    sums = rare.join(vocabulary, "word").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.col("c") + 1.0)).alias("log"), F.sum("times").alias("n"))
    inner, seen = F.coalesce("log", F.lit(0.0)), F.coalesce("n", F.lit(0))
    return scored.drop("rare", "times").join(sums, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("met") + seen).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("head_log") + inner - F.col("n_tokens") * float(np.log10(total + types + 1))).alias("base_score"),
        (F.col("class_log") + inner).alias("score"))


def op5_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op5_lm": op5_lm}
SQL: dict[str, str] = {}

"""Merkle manifest of a dataset as a tree of SHA-256 midstates.

A row's digest is a leaf; leaves of a group ascend by id, every ``fanout``
consecutive nodes of a level become their parent while more than one node is left,
and the groups' subroots are the leaves of one more tree, whose top is the root.

A parent keeps a copy of its hash state before each child slot.  To fold a leaf that
was replaced, the state before its slot is resumed with the replacement and the
siblings to its right only; what is left of it isn't hashed again.

On Spark: leaves are dealt to range partitions by group and id and numbered by
running counts, then a level's nodes are grouped by ``fanout ** levels`` consecutive
ones (at most ``CHUNK``), each chunk a subtree of a task of its own, so a group of any
size is many tasks; the chunks' tops are the nodes of the next round.  On the way
back each chunk gets the path from its top to the root (slot and siblings of each
level, a few digests), builds its own states and folds its leaves.  A hash state
can't leave its process, so a chunk resumes the states of the nodes above it from the
siblings to their left, once for all of its leaves.

Defined results: a null field counts as ``-``; null ids come first, ties of the id go
by digest, rows that are equal throughout have leaves of their own; a null group is a
group and the first one; a group of one leaf is its own subroot; a lone last node
becomes a parent by itself.  Other columns are ignored, whatever their names.  An
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tablewright.llm.common import materialize, table

FANOUT, CHUNK = 2, 4096
FIELDS, GROUP, ID, COUNT = ("doc_id", "source", "lang", "n_chars", "text"), "lang", "doc_id", "n_chars"
STEP = pa.struct([("slot", pa.int32()), ("siblings", pa.list_(pa.string()))])
PATH = "array<struct<slot: int, siblings: array<string>>>"


def digest(fields: Sequence[Column]) -> Column:
    """SHA-256 of the fields, each as its length in UTF-8 bytes, a colon and its text, or ``-`` if null."""
    text = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]), 256)


def group_key(group: Column) -> Column:
    """The group as text that sorts as the groups do: null first, then bytewise."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("-"))


def parent(children: Sequence[str]) -> tuple[str, list]:
    """Digest of a parent and its hash states before each child slot."""
    h, states = hashlib.sha256(), []
    for c in children:
        states.append(h.copy())
        h.update(c.encode())
    return h.hexdigest(), states


def resumed(state, replacement: str, right: Sequence[str]) -> str:
    """Digest of a parent with another child: its state before the slot, the child, the siblings to the right."""
    h = state.copy()
    h.update(replacement.encode())
    for c in right:
        h.update(c.encode())
    return h.hexdigest()


def height(n: int, fanout: int) -> int:
    """Levels from ``n`` nodes to one."""
    h = 0
    while n > 1:
        n, h = -(-n // fanout), h + 1
    return h


def levels_of_chunk(n: int, fanout: int, chunk: int) -> int:
    """Levels that a chunk rises in a round over ``n`` nodes: to the top, or what fills a chunk."""
    return height(n if n <= chunk else chunk, fanout)


def chunk_size(fanout: int) -> int:
    size = fanout
    while size * fanout <= CHUNK:
        size *= fanout
    return size


class Subtree:
    """The levels over a chunk's nodes, with the states of all parents."""

    def __init__(self, nodes: list[str], levels: int, fanout: int):
        self.fanout, self.nodes, self.states = fanout, [nodes], []
        for _ in range(levels):
            below = self.nodes[-1]
            made = [parent(below[at:at + fanout]) for at in range(0, len(below), fanout)]
            self.nodes.append([d for d, _ in made])
            self.states.append([s for _, s in made])

    @property
    def top(self) -> str:
        return self.nodes[-1][0]

    def path(self, at: int) -> list[tuple[int, list[str]]]:
        """Slot and siblings of node ``at`` and of all nodes above it in the chunk."""
        out = []
        for below in self.nodes[:-1]:
            first, slot = at - at % self.fanout, at % self.fanout
            run = below[first:first + self.fanout]
            out.append((slot, run[:slot] + run[slot + 1:]))
            at //= self.fanout
        return out

    def folded(self, at: int, replacement: str) -> str:
        """The chunk's top with another node ``at``."""
        for below, states in zip(self.nodes, self.states):
            slot, up = at % self.fanout, at // self.fanout
            replacement = resumed(states[up][slot], replacement, below[at + 1:(up + 1) * self.fanout])
            at = up
        return replacement


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with their place in their group ``g`` in the order of ``order`` (from 0) and the group's size ``n``, written.

    Rows are dealt to range partitions, numbered within them and moved on by the counts of the partitions before."""
    dealt = materialize(rows.repartitionByRange("g", *order).withColumn("part", F.spark_partition_id()), "dealt")
    sizes = dealt.groupBy("part", "g").agg(F.count("*").alias("size"))
    group = Window.partitionBy("g")
    before = F.sum("size").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    # Written: its join then knows its size, one row for each partition and group.
    sizes = materialize(sizes.select("part", "g", F.coalesce(before, F.lit(0)).alias("before"), F.sum("size").over(group).alias("n")), "sizes")
    place = F.row_number().over(Window.partitionBy("part", "g").orderBy(*order)) - 1
    return materialize(dealt.withColumn("place", place).join(sizes, ["part", "g"]).withColumn("pos", F.col("before") + F.col("place"))
                       .drop("part", "place", "before"), "numbered")


def rise(nodes: DataFrame, fanout: int) -> list[DataFrame]:
    """Rounds from ``nodes`` (g, pos, n, digest) to one node a group, each written."""
    size = chunk_size(fanout)

    def top(key: tuple, chunk: pa.Table) -> pa.Table:
        chunk = chunk.sort_by("pos")
        n = chunk["n"][0].as_py()
        tree = Subtree(chunk["digest"].to_pylist(), levels_of_chunk(n, fanout, size), fanout)
        return pa.table({"g": pa.array([key[0].as_py()], pa.string()), "pos": pa.array([key[1].as_py()], pa.int64()),
                         "n": pa.array([-(-n // size)], pa.int64()), "digest": pa.array([tree.top], pa.string())})

    rounds, most = [nodes], nodes.agg(F.max("n")).first()[0] or 0
    while len(rounds) == 1 or most > 1:
        up = rounds[-1].select("g", "n", "pos", "digest", F.floor(F.col("pos") / size).alias("c")).groupBy("g", "c").applyInArrow(
            top, "g string, pos long, n long, digest string")
        rounds.append(materialize(up, "nodes"))
        most = -(-most // size)
    return rounds


def paths(nodes: DataFrame, above: DataFrame, fanout: int) -> DataFrame:
    """The paths to the root of all ``nodes`` of a round, given those of their chunks' tops ``above`` (g, pos, path)."""
    size = chunk_size(fanout)

    def down(key: tuple, chunk: pa.Table, top: pa.Table) -> pa.Table:
        chunk = chunk.sort_by("pos")
        tree = Subtree(chunk["digest"].to_pylist(), levels_of_chunk(chunk["n"][0].as_py(), fanout, size), fanout)
        rest = [(s["slot"], s["siblings"]) for s in top["path"][0].as_py()]
        made = [[{"slot": s, "siblings": b} for s, b in tree.path(at) + rest] for at in range(chunk.num_rows)]
        return pa.table({"g": chunk["g"], "pos": chunk["pos"], "path": pa.array(made, pa.list_(STEP))})

    left = nodes.select("g", "pos", "n", "digest", F.floor(F.col("pos") / size).alias("c")).groupBy("g", "c")
    right = above.select("g", F.col("pos").alias("c"), "path").groupBy("g", "c")
    return materialize(left.cogroup(right).applyInArrow(down, f"g string, pos long, path {PATH}"), "paths")


@dataclass
class Manifest:
    """``leaves``: g, pos, n, digest and the columns kept; ``tops``: g, pos (of a chunk of leaves), path to the
    root; ``roots``: g, subroot, root."""

    leaves: DataFrame
    tops: DataFrame
    roots: DataFrame
    fanout: int


def manifest(rows: DataFrame, order: Sequence[str], fanout: int = FANOUT) -> Manifest:
    """The tree over ``rows`` (g: the group's key, digest, and columns to keep), in each group by ``order``."""
    if fanout < 2:
        raise ValueError(f"fanout: {fanout}")
    leaves = numbered(rows, order)
    rounds = rise(leaves, fanout)
    subroots = rounds[-1].select(F.col("g").alias("group"), F.lit("").alias("g"), "digest")
    groups = numbered(subroots, ["group"])
    upper = rise(groups, fanout)
    path = upper[-1].select("g", "pos", F.lit(None).cast(PATH).alias("path")).withColumn("path", F.coalesce("path", F.array().cast(PATH)))
    for nodes in reversed(upper[:-1]):
        path = paths(nodes, path, fanout)
    roots = groups.select("pos", F.col("group").alias("g"), F.col("digest").alias("subroot"))
    path = path.drop("g").join(roots, "pos").select("g", F.lit(0).cast("long").alias("pos"), "path")
    for nodes in reversed(rounds[1:-1]):
        path = paths(nodes, path, fanout)
    root = upper[-1].select(F.col("digest").alias("root"))  # one row, none if there is no leaf
    return Manifest(leaves, path, materialize(roots.drop("pos").join(F.broadcast(root)), "roots"), fanout)


def verify(tree: Manifest, keep: Sequence[str], replacement: str) -> DataFrame:
    """``keep``, leaf, subroot, root, proof_sha256, folded_root and verified for every leaf of ``tree``: the digest of
    the siblings on its way to the root, and the root folded from the column ``replacement`` (its own digest if null)."""
    size, fanout = chunk_size(tree.fanout), tree.fanout

    def fold(key: tuple, chunk: pa.Table, top: pa.Table) -> pa.Table:
        chunk = chunk.sort_by("pos")
        leaves = chunk["digest"].to_pylist()
        within = Subtree(leaves, levels_of_chunk(chunk["n"][0].as_py(), fanout, size), fanout)
        rest = [(s["slot"], s["siblings"]) for s in top["path"][0].as_py()]
        # The states of the nodes above before the slot of this chunk, resumed by all of its leaves.
        above = [(parent([*b[:s], ""])[1][s], b[s:]) for s, b in rest]
        tail = "".join(d for _, b in rest for d in b).encode()
        proofs, folded = [], []
        for at, (leaf, other) in enumerate(zip(leaves, chunk[replacement].to_pylist())):
            proof = hashlib.sha256("".join(d for _, b in within.path(at) for d in b).encode())
            proof.update(tail)
            proofs.append(proof.hexdigest())
            node = within.folded(at, other or leaf)
            for state, right in above:
                node = resumed(state, node, right)
            folded.append(node)
        return pa.table({"g": chunk["g"], **{c: chunk[c] for c in keep}, "leaf": chunk["digest"], "proof_sha256": pa.array(proofs, pa.string()),
                         "folded_root": pa.array(folded, pa.string())})

    kinds = dict(tree.leaves.dtypes)
    schema = ", ".join(["g string", *(f"`{c}` {kinds[c]}" for c in keep), "leaf string, proof_sha256 string, folded_root string"])
    left = tree.leaves.select("g", "pos", "n", "digest", *keep, replacement, F.floor(F.col("pos") / size).alias("c")).groupBy("g", "c")
    right = tree.tops.select("g", F.col("pos").alias("c"), "path").groupBy("g", "c")
    done = left.cogroup(right).applyInArrow(fold, schema)
    return done.join(tree.roots, "g").select(*keep, "leaf", "subroot", "root", "proof_sha256", "folded_root",
                                             (F.col("folded_root") == F.col("root")).alias("verified"))


def document_leaves(docs: DataFrame, tampered: Column) -> DataFrame:
    """g, id, digest and, where ``tampered`` holds, the digest with one more character counted."""
    more = F.when(tampered, digest([F.col(c).cast("decimal(20,0)") + 1 if c == COUNT else F.col(c) for c in FIELDS]))
    rows = docs.select(group_key(F.col(GROUP)).alias("g"), ID, digest([F.col(c) for c in FIELDS]).alias("digest"), more.alias("replacement"))
    # The last key of the order: equal rows are told apart, so that no number of them is one partition.
    return materialize(rows.withColumn("row", F.monotonically_increasing_id()), "digests")


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col(ID).cast("string").cast("binary")) % 7 == 0
    leaves = document_leaves(table(spark, sf_dir, "documents"), tampered)
    return verify(manifest(leaves, [ID, "digest", "row"]), [ID], "replacement")


def _sql(levels: int = 22, upper: int = 10) -> str:
    """The tree level by level, for up to 2 ** ``levels`` documents of a language and 2 ** ``upper`` languages."""
    field = lambda c: f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
    row = lambda count: " || ".join(count if c == COUNT else field(c) for c in FIELDS)
    out = [f"""crc AS MATERIALIZED (SELECT *, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''),
    lambda ch: ascii(ch)::BIGINT)), lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda x, i: xor(x >> 1, (x & 1) * 3988292384))), 4294967295::BIGINT) AS crc FROM documents)""",
           f"""d AS MATERIALIZED (SELECT row_number() OVER () AS id, doc_id, lang, sha256({row(field(COUNT))}) AS leaf,
    CASE WHEN crc % 7 = 0 AND {COUNT} IS NOT NULL THEN sha256({row(field(f"({COUNT} + 1)"))}) END AS other FROM crc)""",
           """l AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, id) - 1 AS pos FROM d)""",
           """n0 AS MATERIALIZED (SELECT lang AS g, pos, count(*) OVER (PARTITION BY lang) AS n, leaf AS h FROM l)""",
           """p0 AS MATERIALIZED (SELECT id, lang AS g, pos, coalesce(other, leaf) AS h, '' AS proof FROM l)"""]

    def level(k: int) -> None:
        out.append(f"""n{k + 1} AS MATERIALIZED (SELECT g, pos // 2 AS pos, (n + 1) // 2 AS n,
    CASE WHEN n > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE any_value(h) END AS h FROM n{k} GROUP BY g, pos // 2, n)""")
        out.append(f"""p{k + 1} AS MATERIALIZED (SELECT p.id, p.g, p.pos // 2 AS pos, proof || coalesce(s.h, '') AS proof,
    CASE WHEN o.n = 1 THEN p.h WHEN p.pos % 2 = 0 THEN sha256(p.h || coalesce(s.h, '')) ELSE sha256(s.h || p.h) END AS h
  FROM p{k} p JOIN n{k} o ON o.g IS NOT DISTINCT FROM p.g AND o.pos = p.pos LEFT JOIN n{k} s ON s.g IS NOT DISTINCT FROM p.g
    AND s.pos = xor(p.pos, 1))""")

    for k in range(levels):
        level(k)
    out.append(f"""subroots AS MATERIALIZED (SELECT g AS lang, h AS subroot, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS pos FROM n{levels})""")
    out.append(f"n{levels + 1} AS MATERIALIZED (SELECT 0 AS g, pos, count(*) OVER () AS n, subroot AS h FROM subroots)")
    out.append(f"""p{levels + 1} AS MATERIALIZED (SELECT id, 0 AS g, s.pos, h, proof FROM p{levels} p JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.g)""")
    for k in range(levels + 1, levels + 1 + upper):
        level(k)
    last = levels + 1 + upper
    return "WITH " + ",\n".join(out) + f"""
SELECT l.doc_id, l.leaf, s.subroot, r.h AS root, sha256(p.proof) AS proof_sha256, p.h AS folded_root, p.h = r.h AS verified
FROM l JOIN p{last} p USING (id) JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang CROSS JOIN n{last} r"""


QUERIES = {"op13_merkle": op13_merkle}
OP13_SQL = _sql()
SQL = {"op13_merkle": OP13_SQL}

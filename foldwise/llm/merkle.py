"""Merkle manifest of a table: a tree of SHA-256 digests whose parents keep the state of the hash before each child.

Leaves are ordered inside groups; every eight consecutive nodes make a parent, level by level, until a group has one node, its
subroot. Subroots, ordered by group, make the root the same way. A parent is the hash of its children's hexadecimal digests one
after the other. While it is made, a copy of the hash state is kept before each child's place; checking another digest at that place
resumes the copy with that digest and the siblings to its right, and never reads those to the left again.

Trees are built in runs of 512 nodes (three levels). A run is one row, so no group of leaves, however large, meets in a
task, and a pass leaves a 512th of the nodes. Downwards every run gets its path: by level the siblings to the left and to the right.
Its upper states are made once from the path and copied for each of its leaves.

Null keys come first, rows of one key in the order of their digests; rows alike in both are interchangeable. A null group is a group
of its own, before all others; groups are ordered bytewise. An empty table has no leaves, and a manifest without rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.llm.common import Scratch, placed, short_batches

FAN, RUN_LEVELS = 8, 3
RUN = FAN ** RUN_LEVELS
PATH = "g string, pos long, left array<string>, right array<string>, subroot string, root string"


def digest(*values: Column) -> Column:
    """H of several values: each its length in bytes, a colon and the value, or a hyphen if it is null."""
    def part(v: Column) -> Column:
        text = v.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.sha2(F.concat(*map(part, values)).cast("binary"), 256)


class Parent:
    """A node over up to eight children, with the hash state before each of them."""

    __slots__ = ("children", "states", "digest")

    def __init__(self, children: list[bytes]):
        self.children, self.states, state = children, [], hashlib.sha256()
        for child in children:
            self.states.append(state.copy())
            state.update(child)
        self.digest = state.hexdigest().encode()

    def fold(self, slot: int, child: bytes) -> bytes:
        """The digest with another child at ``slot``."""
        state = self.states[slot].copy()
        state.update(child)
        state.update(b"".join(self.children[slot + 1:]))
        return state.hexdigest().encode()


class Tree:
    """All levels over the nodes of one run."""

    def __init__(self, nodes: list[bytes], of_group: int):
        self.levels: list[list[Parent]] = []
        while len(self.levels) < RUN_LEVELS and FAN ** len(self.levels) < of_group:
            self.levels.append([Parent(nodes[i:i + FAN]) for i in range(0, len(nodes), FAN)])
            nodes = [p.digest for p in self.levels[-1]]
        self.top = nodes[0]

    def steps(self, at: int) -> Iterable[tuple[Parent, int]]:
        for parents in self.levels:
            yield parents[at // FAN], at % FAN
            at //= FAN

    def fold(self, at: int, node: bytes) -> bytes:
        for parent, slot in self.steps(at):
            node = parent.fold(slot, node)
        return node

    def siblings(self, at: int) -> list[tuple[bytes, bytes]]:
        """By level what stands to the left and to the right of the path."""
        return [(b"".join(p.children[:slot]), b"".join(p.children[slot + 1:])) for p, slot in self.steps(at)]


class Climb:
    """The path above a run: one state a level, made from the left siblings once."""

    def __init__(self, left: list[str], right: list[str]):
        self.steps = [(hashlib.sha256(a.encode()), b.encode()) for a, b in zip(left, right)]
        self.known: dict[bytes, bytes] = {}

    def fold(self, node: bytes) -> bytes:
        if node not in self.known:
            top = node
            for state, right in self.steps:
                state = state.copy()
                state.update(top + right)
                top = state.hexdigest().encode()
            self.known[node] = top
        return self.known[node]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, pa.StructArray, Tree]]:
    """Every run: its row, its nodes in order, and its tree."""
    for batch in batches:
        nodes, others = batch.column("nodes"), [c for c in batch.schema.names if c != "nodes"]
        flat, ends, rows = nodes.flatten(), np.cumsum(pc.list_value_length(nodes).to_numpy(zero_copy_only=False)), batch.select(others).to_pylist()
        for row, end, at in zip(rows, ends.tolist(), [0, *ends.tolist()]):
            own = flat.slice(at, end - at)
            yield row, own, Tree([d.encode() for d in own.field("digest").to_pylist()], row["n"])


def _above(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes that runs become."""
    rows = [{"g": row["g"], "run": row["run"] // RUN, "pos": row["run"], "n": -(-row["n"] // RUN), "digest": tree.top.decode()}
            for row, _, tree in _runs(batches)]
    if rows:
        yield pa.RecordBatch.from_pylist(rows)


def _below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The paths of a run's nodes from that of the run."""
    for row, own, tree in _runs(batches):
        sides, text = [tree.siblings(i) for i in range(len(own))], pa.list_(pa.string())
        yield pa.RecordBatch.from_pydict({
            "g": pa.array([row["g"]] * len(own), pa.string()), "pos": own.field("pos"),
            "left": pa.array([[a.decode() for a, _ in s] + row["left"] for s in sides], text),
            "right": pa.array([[b.decode() for _, b in s] + row["right"] for s in sides], text),
            "subroot": pa.array([row["subroot"]] * len(own), pa.string()), "root": pa.array([row["root"]] * len(own), pa.string())})


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of every leaf its proof, and the root that its offered digest leads to."""
    for row, own, tree in _runs(batches):
        climb = Climb(row["left"], row["right"])
        above = "".join(a + b for a, b in zip(row["left"], row["right"])).encode()
        proofs = [hashlib.sha256(b"".join(a + b for a, b in tree.siblings(i)) + above).hexdigest() for i in range(len(own))]
        folded = [climb.fold(tree.fold(i, new.encode())).decode() for i, new in enumerate(own.field("offered").to_pylist())]
        yield pa.RecordBatch.from_pydict({
            "key": own.field("key"), "leaf": own.field("digest"), "subroot": pa.array([row["subroot"]] * len(own), pa.string()),
            "root": pa.array([row["root"]] * len(own), pa.string()), "proof_sha256": pa.array(proofs, pa.string()),
            "folded_root": pa.array(folded, pa.string()), "verified": pa.array([f == row["root"] for f in folded], pa.bool_())})


class Manifest:
    """The tree over ``leaves(grp, key, digest, offered)``: its tables lie in the scratch folder and serve any number of checks."""

    def __init__(self, leaves: DataFrame, scratch: Scratch):
        self.spark, self.scratch = leaves.sparkSession, scratch
        self.key = leaves.schema["key"].dataType.simpleString()
        named = scratch.keep(leaves.select(F.coalesce(F.concat(F.lit("."), F.col("grp").cast("string")), F.lit("")).alias("g"),
                                           "key", "digest", "offered"), "hashed")  # texts are read and hashed once
        self.passes = self._up(placed(named, "g", [F.col("key").asc_nulls_first(), F.col("digest")], scratch, "leaves-ordered"),
                               ["key", "offered"], "leaf")
        subroots = self.passes[-1].select(F.lit("").alias("g"), F.col("g").alias("of"), F.col("nodes")[0]["digest"].alias("digest"))
        self.group_passes = self._up(placed(subroots, "g", [F.col("of")], scratch, "subroots-ordered"), ["of"], "group")
        scratch.drop("hashed", "leaves-ordered", "subroots-ordered")

    def _up(self, nodes: DataFrame, more: list[str], name: str) -> list[DataFrame]:
        """The runs of each pass, until every group has one node."""
        nodes, passes = nodes.withColumn("run", F.floor(F.col("pos") / RUN).cast("long")), []
        while True:
            runs = nodes.groupBy("g", "run").agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("pos", "digest", *more))).alias("nodes"))
            passes.append(short_batches(self.scratch.keep(runs, f"{name}-pass-{len(passes)}")))
            if (passes[-1].agg(F.max("n")).first()[0] or 0) <= 1:
                return passes
            nodes, more = passes[-1].mapInArrow(_above, "g string, run long, pos long, n long, digest string"), []

    def root(self) -> str | None:
        row = self.group_passes[-1].select(F.col("nodes")[0]["digest"]).first()
        return row[0] if row else None

    @staticmethod
    def _with_path(runs: DataFrame, paths: DataFrame) -> DataFrame:
        paths = paths.withColumnsRenamed({"g": "of_g", "pos": "of_run"})
        return runs.join(paths, (F.col("g") == F.col("of_g")) & (F.col("run") == F.col("of_run"))).drop("of_g", "of_run")

    def _down(self, top: DataFrame, passes: list[DataFrame], name: str) -> DataFrame:
        """The paths of all runs below the top, from the paths of the top nodes."""
        for i in range(len(passes) - 2, -1, -1):
            top = self.scratch.keep(self._with_path(passes[i], top).mapInArrow(_below, PATH), f"{name}-path-{i}")
        return top

    def check(self) -> DataFrame:
        """``key, leaf, subroot, root, proof_sha256, folded_root, verified`` of every leaf."""
        none, digest_ = F.array().cast("array<string>"), F.col("nodes")[0]["digest"]
        top = self.group_passes[-1].select("g", F.lit(0).cast("long").alias("pos"), none.alias("left"), none.alias("right"),
                                           digest_.alias("subroot"), digest_.alias("root"))
        found = self._down(top, self.group_passes, "group").drop("subroot", "g")
        named = self.group_passes[0].select(F.explode("nodes").alias("node")).select(
            F.col("node.pos").alias("p"), F.col("node.of").alias("g"), F.col("node.digest").alias("subroot"))
        groups = found.join(named, found["pos"] == named["p"]).select(
            "g", F.lit(0).cast("long").alias("pos"), "left", "right", "subroot", "root")
        runs = self._down(groups, self.passes[1:], "leaf") if len(self.passes) > 1 else groups
        kind = (f"key {self.key}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
                "verified boolean")
        return self._with_path(self.passes[0], runs).mapInArrow(_checked, kind)


def documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The leaves of ``documents``: by language in the order of ids; where 3 divides the id's checksum, the offered digest is that
    of the text with A to Z in lower case."""
    upper = "".join(map(chr, range(65, 91)))
    kept = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    hit = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 0
    leaf = digest(*kept, F.col("text"))
    changed = digest(*kept, F.translate("text", upper, upper.lower()))
    return docs.select(F.col("lang").alias("grp"), F.col("doc_id").alias("key"), leaf.alias("digest"),
                       F.when(hit, changed).otherwise(leaf).alias("offered"))

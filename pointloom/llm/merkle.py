"""Merkle manifest of a dataset as an append log in postorder.

The rows of a language, in order, are the leaves of a tree of eight children a node; the trees'
roots are the leaves of one more tree. Builders own aligned ranges of leaves, so that
a builder completes whole subtrees, and append each node when it is complete. Where a node
stands in the log follows from the sizes of the subtrees before it: a proof takes the siblings
of a leaf by computed positions and searches nothing.

A builder spans ``TIER`` levels; the roots of its subtrees are the leaves of the
next tier of builders. No task holds more than one builder's nodes, and only digests are
shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pointloom.llm.common import by_task, pick, written

# Children of a node as a power of two, and the levels that a builder adds.
BITS, TIER = 3, 3
FANOUT = 1 << BITS
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def nodes_at(n: int, level: int) -> int:
    """Nodes at a level of a tree of ``n`` leaves."""
    return -(-n >> BITS * level)


def height(n: int) -> int:
    """The level of the root."""
    level = 0
    while nodes_at(n, level) > 1:
        level += 1
    return level


def position(n: int, level: int, i: int) -> int:
    """How many nodes are complete before node ``i`` of a level, in a tree of ``n`` leaves.

    Before it come all nodes below it and below its left neighbours, these neighbours, and the
    ancestors that end with one of them.
    """
    below = sum(min(i + 1 << BITS * (level - at), nodes_at(n, at)) for at in range(level))
    above, rest = 0, i >> BITS
    while rest:
        above, rest = above + rest, rest >> BITS
    return below + i + above


def combined(digests: bytes) -> bytes:
    """The digest over digests, which go in as hex text."""
    return hashlib.sha256(digests.hex().encode()).digest()


def folded(digest: bytes, path: list[tuple[int, bytes]]) -> bytes:
    """The root that a digest and the siblings of each level above it make."""
    for place, siblings in path:
        at = 32 * place
        digest = combined(siblings[:at] + digest + siblings[at:])
    return digest


def encoded(path: list[tuple[int, bytes]]) -> bytes:
    return b"".join(bytes((place, len(s) // 32)) + s for place, s in path)


def decoded(data: bytes) -> list[tuple[int, bytes]]:
    path, at = [], 0
    while at < len(data):
        end = at + 2 + 32 * data[at + 1]
        path.append((data[at], data[at + 2 : end]))
        at = end
    return path


def leaf_digest(text: str = "text") -> Column:
    """The digest of a row as 32 bytes: of each column ``-`` if null, else length and value."""

    def piece(name: str) -> Column:
        value = F.col(name).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*[piece(text if c == "text" else c) for c in COLUMNS]), 256))


def tampered(text: str = "text") -> Column:
    """The text with A to Z in lower case where 3 divides the CRC of the id, else null."""
    hit = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return F.when(hit, F.translate(text, _UPPER, _LOWER))


def tree_key(lang: Column) -> Column:
    """The name of a language's tree: null comes first, then by bytes."""
    return F.coalesce(F.concat(F.lit("="), lang.cast("string")), F.lit(""))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``i``, the place of a row in its ``tree`` by ``order``, and ``n``, the tree's size.

    ``rows`` is a written table, so that equal rows keep their order. Sorted by range over tree and
    order, a large tree spreads over many tasks; each numbers its own rows, and one row per
    task and tree tells what comes before.
    """
    keys = ["tree", *order, "tie"]
    ordered = (
        rows.withColumn("tie", F.monotonically_increasing_id())
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .select(*rows.columns)
    )

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, object]]:
        part, tree, at = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            places = []
            for name in batch["tree"].to_pylist():
                at = at + 1 if name == tree else 0
                tree = name
                places.append(at)
            columns = {c: batch[c] for c in batch.schema.names}
            yield {**columns, "part": [part] * len(places), "at": places}

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    placed = written(by_task(ordered, f"{schema}, part int, at long", convert), "numbered")
    # A row per task and tree that it has.
    runs = placed.groupBy("tree", "part").agg((F.max("at") + 1).alias("size"))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "tree",
        "part",
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("begun"),
        F.sum("size").over(whole).alias("n"),
    )
    return placed.join(runs, ["tree", "part"]).select(
        *rows.columns, (F.col("begun") + F.col("at")).alias("i"), "n"
    )


_NODE = {
    "tree": "string", "n": "long", "level": "int", "i": "long", "position": "long",
    "digest": "binary", "name": "string", "shown": "binary",
}


def _node_schema() -> str:
    return ", ".join(f"{name} {kind}" for name, kind in _NODE.items())


def _dealt(rows: DataFrame, block: Column, order: str) -> DataFrame:
    """All rows of a builder to one task, in order."""
    keyed = rows.withColumn("block", block)
    return keyed.repartition("tree", "block").sortWithinPartitions("tree", "block", order)


def appended(leaves: DataFrame) -> list[DataFrame]:
    """The log of trees, a table per tier of builders: ``tree``, ``n``, ``level``, ``i``,
    ``position``, ``digest``, and of leaves ``name`` and ``shown``.

    ``leaves`` has ``tree``, ``i``, ``n``, ``digest`` and the last two. A builder writes its
    nodes in the order in which they are complete and keeps at most one run of nodes a level.
    """
    most = leaves.agg(F.max("n")).first()[0] or 0
    tiers: list[DataFrame] = []
    rows = leaves.select(
        "tree", "n", F.lit(0).alias("level"), "i", F.lit(0).cast("long").alias("position"),
        "digest", "name", "shown",
    )
    while not tiers or nodes_at(most, TIER * len(tiers)) > 1:
        base = TIER * len(tiers)
        dealt = _dealt(rows, F.shiftright("i", BITS * TIER), "i").select(*_NODE)
        tiers.append(written(by_task(dealt, _node_schema(), _builder(base)), f"log-{base}"))
        rows = tiers[-1].filter((F.col("level") == base + TIER) & (F.col("n") > FANOUT ** (base + TIER)))
    return tiers


def _builder(base: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[dict[str, object]]]:
    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, object]]:
        open_: list[list[bytes]] = [[] for _ in range(TIER + 1)]
        for batch in batches:
            out: dict[str, list] = {name: [] for name in _NODE}

            def write(*values) -> None:
                for column, value in zip(out.values(), values, strict=True):
                    column.append(value)

            for row in batch.to_pylist():
                tree, n, i, digest = row["tree"], row["n"], row["i"], row["digest"]
                top = min(base + TIER, height(n))
                last = i + 1 == nodes_at(n, base)
                if base == 0:  # later tiers begin with nodes that are in the log
                    write(tree, n, 0, i, position(n, 0, i), digest, row["name"], row["shown"])
                open_[0].append(digest)
                level = base
                while level < top and (last or len(open_[level - base]) == FANOUT):
                    digest = combined(b"".join(open_[level - base]))
                    open_[level - base].clear()
                    level, i = level + 1, i >> BITS
                    write(tree, n, level, i, position(n, level, i), digest, None, None)
                    open_[level - base].append(digest)
                if level == top:
                    open_[top - base].clear()
            yield out

    return convert


def roots(log: list[DataFrame]) -> DataFrame:
    """``tree``, ``n`` and ``digest`` of the root of every tree."""
    found = [
        # Only a root is alone at its level; below it are more.
        tier.filter((F.col("i") == 0) & (F.col("position") == _last("n"))).select("tree", "n", "digest")
        for tier in log
    ]
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def _last(n: str) -> Column:
    """The position of the root: all nodes but itself come before it."""
    levels = range(64 // BITS)
    at = [F.ceil(F.col(n) / F.lit(float(FANOUT**level))).cast("long") for level in levels]
    total = at[0]
    for lower, upper in zip(at, at[1:]):
        total = total + F.when(lower > 1, upper).otherwise(F.lit(0))
    return total - 1


_PATH = "tree string, block long, path binary, subroot binary, root binary"


def _paths(log: list[DataFrame], tops: DataFrame, schema: str, last: Callable) -> DataFrame:
    """Proofs from the top tier of builders down: each hands to the builders below it the
    siblings from their roots up. ``last`` makes columns of what the lowest tier finds."""
    handed = tops.sparkSession.createDataFrame([], _PATH)
    for t in reversed(range(len(log))):
        base = TIER * t
        nodes = log[t].filter(F.col("level") < base + TIER)
        if t:
            nodes = nodes.union(log[t - 1].filter(F.col("level") == base))
            nodes = nodes.filter(F.col("n") > FANOUT**base)
        # A builder's rows: what comes from above, then its nodes by position.
        begun = tops.filter(F.col("n") <= FANOUT ** (base + TIER))
        if t:
            begun = begun.filter(F.col("n") > FANOUT**base)
        begun = begun.select("tree", F.lit(0).cast("long").alias("block"), "path", "subroot", "root")
        above = handed.union(begun).withColumn("position", F.lit(-1).cast("long"))
        shift = (F.col("level") * -BITS + BITS * (base + TIER)).cast("int")
        rows = nodes.withColumn("block", F.call_function("shiftright", "i", shift))
        rows = rows.unionByName(above, allowMissingColumns=True)
        dealt = _dealt(rows, F.col("block"), "position")
        if t:
            handed = by_task(dealt, _PATH, _climbed(base, _hand_down))
        else:
            return by_task(dealt, schema, _climbed(base, last))
    raise AssertionError("a log has a tier")


class _Found(NamedTuple):
    """A node with the siblings of each level up to the root of all."""

    row: dict
    path: list[tuple[int, bytes]]
    subroot: bytes
    root: bytes


def _hand_down(found: list[_Found]) -> dict[str, object]:
    return {
        "tree": [f.row["tree"] for f in found],
        "block": [f.row["i"] for f in found],
        "path": [encoded(f.path) for f in found],
        "subroot": [f.subroot for f in found],
        "root": [f.root for f in found],
    }


def _climbed(base: int, emit: Callable[[list[_Found]], dict[str, object]]):
    def builder(rows: list[dict]) -> list[_Found]:
        top, *nodes = rows
        upper, at = decoded(top["path"]), {r["position"]: r["digest"] for r in nodes}
        n = nodes[0]["n"]
        ends = min(base + TIER, height(n))
        runs: dict[tuple[int, int], list[bytes]] = {}

        def siblings(level: int, i: int) -> tuple[int, bytes]:
            first = i >> BITS << BITS
            if (level, first) not in runs:
                run = range(first, min(first + FANOUT, nodes_at(n, level)))
                runs[level, first] = [at[position(n, level, j)] for j in run]
            run, place = runs[level, first], i - first
            return place, b"".join([*run[:place], *run[place + 1 :]])

        found = []
        for row in nodes:
            if row["level"] == base:
                own = [siblings(base + k, row["i"] >> BITS * k) for k in range(ends - base)]
                found.append(_Found(row, [*own, *upper], top["subroot"], top["root"]))
        return found

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, object]]:
        held: list[dict] = []
        for batch in batches:
            found: list[_Found] = []
            for row in batch.to_pylist():
                if row["position"] < 0 and held:  # a builder begins with what it is handed
                    found += builder(held)
                    held = []
                held.append(row)
            if found:
                yield emit(found)
        if held:
            yield emit(builder(held))

    return convert


class Manifest(NamedTuple):
    """The logs of the languages' trees and of the tree above them."""

    trees: list[DataFrame]
    above: list[DataFrame]


def leaves_of(docs: DataFrame) -> DataFrame:
    """``tree``, ``doc_id``, ``digest``, ``name`` and ``shown`` of every row: the digest of the
    row as it is and, where it is tampered with, as it is shown."""
    plain = pick(docs, *COLUMNS).withColumn("changed", tampered())
    return plain.select(
        tree_key(F.col("lang")).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"),
        leaf_digest().alias("digest"),
        F.col("doc_id").cast("string").alias("name"),
        F.when(F.col("changed").isNotNull(), leaf_digest("changed")).alias("shown"),
    )


def manifest(docs: DataFrame) -> Manifest:
    """Build the logs of all rows.

    Leaves ascend by ``doc_id``, null first, then by digest; rows alike are leaves each. No
    column but the five is read; nulls in them count as told at :func:`leaf_digest`.
    """
    leaves = numbered(written(leaves_of(docs), "leaves"), ["doc_id", "digest"]).drop("doc_id")
    trees = appended(leaves)
    tops = roots(trees).select(
        F.lit("").alias("tree"), "digest", F.col("tree").alias("name"),
        F.lit(None).cast("binary").alias("shown"),
    )
    return Manifest(trees, appended(numbered(written(tops, "subroots"), ["name"])))


_PROVED = "name string, digest binary, subroot binary, root binary, path binary"


def _proved(found: list[_Found]) -> dict[str, object]:
    return {
        "name": [f.row["name"] for f in found],
        "digest": [f.row["digest"] for f in found],
        "subroot": [f.subroot for f in found],
        "root": [f.root for f in found],
        "path": [encoded(f.path) for f in found],
    }


def _tree_tops(found: Manifest) -> DataFrame:
    """What the trees' top builders are handed: a row per language."""
    root = roots(found.above).select(
        "tree", "n", F.lit(b"").alias("path"), F.col("digest").alias("subroot"),
        F.col("digest").alias("root"),
    )
    paths = _paths(found.above, root, _PROVED, _proved)
    trees = roots(found.trees).select("tree", "n")
    return trees.join(paths.withColumnRenamed("name", "tree"), "tree").select(
        "tree", "n", "path", F.col("digest").alias("subroot"), "root"
    )


def proofs(found: Manifest) -> DataFrame:
    """``name`` (the id as text), ``digest``, ``subroot``, ``root`` and ``path`` of every leaf:
    siblings level by level, as :func:`decoded` reads them."""
    return _paths(found.trees, _tree_tops(found), _PROVED, _proved)


_AUDITED = (
    "doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
    "folded_root string, verified boolean"
)


def _audited(found: list[_Found]) -> dict[str, object]:
    roots = [folded(f.row["shown"] or f.row["digest"], f.path) for f in found]
    return {
        "doc_id": [None if f.row["name"] is None else int(f.row["name"]) for f in found],
        "leaf": [f.row["digest"].hex() for f in found],
        "subroot": [f.subroot.hex() for f in found],
        "root": [f.root.hex() for f in found],
        "proof_sha256": [combined(b"".join(s for _, s in f.path)).hex() for f in found],
        "folded_root": [r.hex() for r in roots],
        "verified": [r == f.root for r, f in zip(roots, found)],
    }


def audited(docs: DataFrame) -> DataFrame:
    """Every row checked against the manifest by its proof: ``doc_id``, ``leaf``, ``subroot``,
    ``root``, ``proof_sha256`` (over its siblings), ``folded_root`` (from the row as it is
    shown) and ``verified``.

    Rows alike get rows of their own, with the same leaf and each its own proof. Null ids are
    never tampered with; null texts stay null. No rows give no rows.
    """
    found = manifest(docs)
    return _paths(found.trees, _tree_tops(found), _AUDITED, _audited)

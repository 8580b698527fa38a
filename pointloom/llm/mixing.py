"""Mixing sources to target weights by a min-cost flow.

Documents are aggregated by the set of sources they belong to. The flow sends words of each such
pattern to its sources' quotas; words of a first pass over a pattern are cheap, each further
pass costs more. Whole documents are then taken in a seeded order until the flow is met.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pointloom.llm.common import WORD_PATTERN, pick, written

# Parts of the seeded order that are summed before documents are.
BUCKETS = 1 << 14
# Rows alike that one task makes.
COPIES = 1 << 12


def words_in(text: str) -> Column:
    """Number of words of a text, 0 where it is null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def targets(
    sizes: Sequence[int], weights: Sequence[int], share: Fraction, most: int
) -> list[Fraction]:
    """What each source is to give: ``share`` of all sizes by weight, at most ``most`` times its
    own size; what one cannot give the others do, by weight, until none is above.

    Sources are full in the order of size by weight, so one pass over that order finds them.
    """
    left, total = share * sum(sizes), sum(weights)
    found = [Fraction(0)] * len(sizes)
    order = sorted(range(len(sizes)), key=lambda i: Fraction(sizes[i], weights[i]))
    for at, i in enumerate(order):
        if left * weights[i] <= most * sizes[i] * total:
            level = left / total
            for j in order[at:]:
                found[j] = level * weights[j]
            break
        found[i] = Fraction(most * sizes[i])
        left -= found[i]
        total -= weights[i]
    return found


class _Network:
    """Nodes and arcs with room; arc ``a`` and its way back ``a ^ 1``."""

    def __init__(self, n_nodes: int) -> None:
        self.to: list[int] = []
        self.room: list[int] = []
        self.out: list[list[int]] = [[] for _ in range(n_nodes)]

    def link(self, a: int, b: int, room: int) -> int:
        self.out[a].append(len(self.to))
        self.out[b].append(len(self.to) + 1)
        self.to += (b, a)
        self.room += (room, 0)
        return len(self.to) - 2

    def fill(self, source: int, sink: int) -> None:
        """Send as much more as can be sent, all that the shortest ways take at a time."""
        while (level := self._levels(source, sink)) is not None:
            self._block(source, sink, level)

    def _levels(self, source: int, sink: int) -> list[int] | None:
        level = [-1] * len(self.out)
        level[source] = 0
        front = [source]
        while front and level[sink] < 0:
            reached = []
            for a in front:
                for arc in self.out[a]:
                    b = self.to[arc]
                    if self.room[arc] and level[b] < 0:
                        level[b] = level[a] + 1
                        reached.append(b)
            front = reached
        return None if level[sink] < 0 else level

    def _block(self, source: int, sink: int, level: list[int]) -> None:
        to, room, out = self.to, self.room, self.out
        tried = [0] * len(out)
        way: list[int] = []
        at = source
        while True:
            if at == sink:
                moved = min(room[arc] for arc in way)
                for arc in way:
                    room[arc] -= moved
                    room[arc ^ 1] += moved
                full = next(k for k, arc in enumerate(way) if not room[arc])
                at = to[way[full] ^ 1]
                del way[full:]
            while tried[at] < len(out[at]):
                arc = out[at][tried[at]]
                if room[arc] and level[to[arc]] == level[at] + 1:
                    way.append(arc)
                    at = to[arc]
                    break
                tried[at] += 1
            else:
                if not way:
                    return
                at = to[way.pop() ^ 1]
                tried[at] += 1


def min_cost_flow(
    sizes: Sequence[int], members: Sequence[Sequence[int]], quotas: Sequence[int], passes: int
) -> list[int]:
    """Words taken of each pattern: as much of the quotas as can be met, at the least cost.

    Pass ``p`` over a pattern costs ``p`` a word, so costs are convex and words come from
    patterns read less often first. All a way costs is the pass at its beginning; so the cheapest
    ways are those of the passes opened first, and it takes a blocking flow over the network of
    patterns and sources for each pass that is opened. A pattern of one source that no other
    pattern has is not in that network. Its size depends on how many sets of sources
    there are, not on the documents.
    """
    patterns = [0] * len(quotas)
    for some in members:
        for s in some:
            patterns[s] += 1
    taken = [0] * len(sizes)
    shared = []
    for i, some in enumerate(members):
        if len(some) > 1 or (some and patterns[some[0]] > 1):
            shared.append(i)
        elif some:
            taken[i] = min(passes * sizes[i], quotas[some[0]])
    place = {s: k for k, s in enumerate(sorted({s for i in shared for s in members[i]}), len(shared))}
    source, sink = len(shared) + len(place), len(shared) + len(place) + 1
    network = _Network(sink + 1)
    for s, node in place.items():
        network.link(node, sink, quotas[s])
    opened = []
    for k, i in enumerate(shared):
        opened.append(network.link(source, k, 0))
        for s in members[i]:
            network.link(k, place[s], passes * sizes[i])
    for _ in range(passes):
        for arc, i in zip(opened, shared):
            network.room[arc] += sizes[i]
        network.fill(source, sink)
    for arc, i in zip(opened, shared):
        taken[i] = network.room[arc ^ 1]
    return taken


class Mix(NamedTuple):
    """``taken`` joins documents to what is taken of them; ``sources`` is a row per source."""

    taken: DataFrame
    sources: list[tuple[str | None, int, float]]  # name, size, target


def mix(
    docs: DataFrame,
    key: Sequence[str],
    weights: Sequence[int] = (3, 1, 2),
    share: Fraction = Fraction(3, 2),
    most: int = 2,
    seed: int = 5,
) -> Mix:
    """Take words of documents so that sources come near their targets.

    ``docs`` has the columns of ``key`` (what tells a document apart, best with a hash of the
    text), ``sources`` (an array: all that a document belongs to, null being one) and ``size``
    (words). Sources weigh ``weights`` by code point order of their names, null last, over and
    over. ``taken`` has the key, ``sources``, ``size`` and ``taken``: multiples of the size up to
    ``most``, but for one document a pattern that is taken in part. A document
    belonging to no source, or of size 0, gives nothing. Rows alike in all columns may differ in
    ``taken``, as one of them may be the last to be taken.

    The driver holds a row per set of sources. Documents are ordered by a hash with the seed;
    parts of that order are summed first, and only narrow rows are shuffled. Rows alike are
    one row with a count until the end, when they become rows again, ``COPIES`` at a time.
    """
    spark = docs.sparkSession
    docs = docs.select(*key, F.sort_array("sources").alias("sources"), "size")
    patterns = docs.groupBy("sources").agg(F.sum("size").alias("size")).collect()
    names = sorted(
        {s for p in patterns for s in p["sources"]}, key=lambda s: (s is None, s or "")
    )
    number = {name: i for i, name in enumerate(names)}
    sizes = [0] * len(names)
    for p in patterns:
        for name in set(p["sources"]):
            sizes[number[name]] += p["size"]
    cycle = [weights[i % len(weights)] for i in range(len(names))]
    wanted = targets(sizes, cycle, share, most)
    flow = min_cost_flow(
        [p["size"] for p in patterns],
        [sorted({number[s] for s in p["sources"]}) for p in patterns],
        [round(w) for w in wanted],
        most,
    )
    sources = [(n, z, float(w)) for n, z, w in zip(names, sizes, wanted, strict=True)]
    if not patterns:
        return Mix(docs.withColumn("taken", F.lit(0).cast("long")), sources)

    plan = [
        (p["sources"], f // p["size"] if p["size"] else 0, f % p["size"] if p["size"] else 0)
        for p, f in zip(patterns, flow, strict=True)
    ]
    schema = "sources array<string>, whole long, rest long"
    pattern = spark.createDataFrame(plan, schema).select(
        F.to_json(F.struct("sources")).alias("pattern"), "whole", "rest"
    )
    order = F.xxhash64(*key, F.lit(seed))
    alike = docs.groupBy(*key, "sources", "size").agg(F.count(F.lit(1)).alias("copies"))
    placed = alike.withColumns(
        {
            "pattern": F.to_json(F.struct("sources")),
            "order": order,
            "bucket": F.shiftrightunsigned(order, 64 - (BUCKETS.bit_length() - 1)).cast("int"),
            "words": F.col("size") * F.col("copies"),
        }
    )
    before = Window.partitionBy("pattern").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = placed.groupBy("pattern", "bucket").agg(F.sum("words").alias("total"))
    # A row per set of sources and bucket at most.
    begun = buckets.withColumn("begun", F.coalesce(F.sum("total").over(before), F.lit(0)))
    begun = begun.join(F.broadcast(pattern), "pattern").drop("total")
    inside = (
        Window.partitionBy("pattern", "bucket")
        .orderBy("order", *key, "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    start = F.col("begun") + F.coalesce(F.sum("words").over(inside), F.lit(0))
    ranged = placed.join(begun, ["pattern", "bucket"]).select(
        *key, "sources", "size", "copies", "whole", "rest", start.alias("start")
    )
    few = ranged.filter(F.col("copies") <= COPIES).withColumn("part", F.lit(0).cast("long"))
    parts = F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / COPIES))
    many = ranged.filter(F.col("copies") > COPIES).withColumn("part", F.explode(parts))
    rows = few.unionByName(many.repartition(*key, "part"))
    first = F.col("part") * COPIES
    copy = F.explode(F.sequence(first, F.least(first + COPIES, F.col("copies")) - 1))
    place = F.col("start") + F.col("copy") * F.col("size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - place))
    taken = rows.withColumn("copy", copy).withColumn(
        "taken", (F.col("whole") * F.col("size") + part).cast("long")
    )
    return Mix(taken.select(*key, "sources", "size", "taken"), sources)


def of_documents(docs: DataFrame) -> DataFrame:
    """What :func:`mix` takes: ``doc_id``, ``text_hash``, ``sources``, ``size``.

    Null texts have size 0. Every document belongs to the one source in ``source``.
    """
    return pick(docs, "doc_id", "text", "source").select(
        F.col("doc_id").cast("long"),
        F.xxhash64("text").alias("text_hash"),
        F.array(F.col("source").cast("string")).alias("sources"),
        words_in("text").alias("size"),
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target`` and ``taken`` of every document."""
    narrow = written(of_documents(docs), "sizes")  # texts are read once
    found = mix(narrow, ["doc_id", "text_hash"], **options)
    spark = docs.sparkSession
    sources = spark.createDataFrame(
        found.sources, "source string, source_size long, target double"
    )
    rows = found.taken.withColumn("source", F.col("sources")[0])
    same = rows["source"].eqNullSafe(sources["source"])
    return rows.join(F.broadcast(sources), same).select(
        "doc_id", "size", "source_size", "target", "taken"
    )

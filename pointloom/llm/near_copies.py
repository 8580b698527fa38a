"""MinHash near-duplicates: one permutation, optimal densification, bands, stars.

A document is its set of distinct word shingles, hashed once each. The range of hashes is cut into
bins and the smallest hash of each is its value; an empty bin takes the value of the first bin that
is not empty in an order of its own, drawn at random: drawing bins over and over until one is
not empty does just that. Values go into bands; documents that agree on a whole band share a bucket.

In a bucket all meet one hub, a star of as many candidate edges as it has members, and the full
sets confirm or refuse each edge. The hub is the member that shares the most buckets with others: of
copies that were each changed a little that is the one they were made of. Where a bucket's other members
still lie in several components, more of them become hubs, many times as many each round, and meet
those of other components, until all members that never were hubs lie in one: then no pair that
shares a bucket is left that could join two components. Before rounds of very many hubs those go that
can be similar to no set of another component: too few of their shingles are in any. So documents that
only share a passage are told apart by counts of shingles, not in pairs.

A pair becomes an edge only if the parities of its sets allow: of each set it is known for every range
of hashes whether it has an odd number there. In a range where two sets differ in that, at least one
shingle is in just one of them, so too many such ranges refuse a pair, and never one that is similar.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pointloom.llm.common import by_task, folder_of, pick, scratch_dir, shingle_hashes, utf8, written
from pointloom.llm.graph import connected

SHINGLE, PERCENT, SEED = 2, 80, 42
# A pair of similarity 0.8 shares no bucket once in 300,000 times.
BANDS, VALUES = 32, 5
BINS = BANDS * VALUES
# Hubs are so many times as many each round; from how many on shingles are counted before it; edges of
# a hub that one task confirms.
MORE_HUBS, MANY_HUBS, EDGES = 16, 1 << 12, 1 << 12
# Longs with the parities of a set, 64 each. Beyond 144 shingles a long they refuse no pair.
PARITIES = 16
# Documents whose sets a task makes, and reads, together; bytes of a file that it reads at once.
ROWS, BUFFER = 1 << 10, 1 << 20
# Rows of a task whose choice is in one part, and parts for each shuffle partition.
STRETCH_BITS, PARTS_PER_SHUFFLE = 12, 4

_EDGES = np.array([-(-(b << 64) // BINS) for b in range(BINS)], np.uint64)
# Rank of every bin in the order in which each empty bin asks them.
_RANK = np.random.default_rng(SEED).permuted(
    np.tile(np.arange(BINS, dtype=np.int16), (BINS, 1)), axis=1
)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SALT = np.random.default_rng(SEED + 1).integers(1, 1 << 63, BANDS, np.uint64)


def shingles(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """Distinct hashes of the shingles, in order. Words are lower-cased in A to Z; fewer words
    than a shingle has are one, no words none."""
    return np.unique(np.array(shingle_hashes(text.lower().split(), size, SEED), np.uint64))


def bin_values(hashes: np.ndarray) -> np.ndarray:
    """The value of every bin, of at least one sorted hash."""
    first = np.searchsorted(hashes, _EDGES)
    filled = first < np.append(first[1:], len(hashes))
    values = np.zeros(BINS, np.uint64)
    values[filled] = hashes[first[filled]]
    if not filled.all():
        having = np.flatnonzero(filled)
        values[~filled] = values[having[_RANK[np.ix_(~filled, having)].argmin(1)]]
    return values


def band_keys(values: np.ndarray) -> np.ndarray:
    """A hash of the values of each band; no two bands share a key, but by accident."""
    keys = _SALT.copy()
    for column in values.reshape(BANDS, VALUES).T:
        keys = (keys ^ column) * _MIX
        keys ^= keys >> np.uint64(29)
    return keys


_SETS = "row long, doc_id long, n_shingles long, set_key binary, keys array<long>, shingles array<long>"
# Rows of a task are numbered on from its own multiple of this.
TASK = 1 << 40
# Numbers of rows in an order as if drawn, and back: products that wrap around.
_SPREAD = 0xD1342543DE82EF95
_GATHER = pow(_SPREAD, -1, 1 << 64)


def spread(rows: np.ndarray) -> np.ndarray:
    """A number of its own for each row, in no order."""
    return (rows.astype(np.uint64) * np.uint64(_SPREAD)).view(np.int64)


def gathered(numbers: np.ndarray) -> np.ndarray:
    """The rows of such numbers."""
    return (numbers.view(np.uint64) * np.uint64(_GATHER)).view(np.int64)


def sets_of(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``row`` (a number of its own), ``doc_id``, ``n_shingles``, ``set_key`` (128 bits that tell
    sets apart), ``keys`` (one per band, none without shingles) and ``shingles`` of every document."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, object]]:
        row = TaskContext.get().partitionId() * TASK
        slices = (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS))
        for batch in slices:
            found = [shingles(t, size) for t in batch["text"].to_pylist()]
            keys = [band_keys(bin_values(f)) if len(f) else f for f in found]
            yield {
                "row": spread(np.arange(row, row + len(found))),
                "doc_id": batch["doc_id"],
                "n_shingles": [len(f) for f in found],
                "set_key": [xxhash.xxh128_digest(f.tobytes()) for f in found],
                "keys": [k.view(np.int64) for k in keys],
                "shingles": [f.view(np.int64) for f in found],
            }
            row += len(found)

    texts = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), utf8("text"))
    return by_task(texts, _SETS, convert)


def parities(sets: pa.ListArray) -> np.ndarray:
    """For every set the parities of how many hashes it has in each class of equal low bits, as longs."""
    bits = 64 * PARITIES
    low = sets.flatten().to_numpy() & (bits - 1)
    place = np.repeat(np.arange(len(sets)) * bits, sets.value_lengths().to_numpy()) + low
    odd = np.bincount(place, minlength=len(sets) * bits).astype(np.uint8) & 1
    return np.packbits(odd).view(np.int64).reshape(-1, PARITIES)


def chosen(sets: DataFrame, rows: DataFrame, only_parities: bool = False) -> DataFrame:
    """``shingles`` (or ``parities`` only) of the sets whose ``row`` is among the rows, once for each of
    these, with its columns, all of them longs. ``sets`` is a table as :func:`sets_of` wrote it.

    The few rows that are asked for go to the shared folder, in parts by stretches of what one
    task wrote. Tasks look up their parts there by the numbers of all rows, and then read, in their
    files, the sets that are asked for, a few at a time: sets are not moved, and no others are read
    but those that share a page with them.
    """
    spark = sets.sparkSession
    parts = PARTS_PER_SHUFFLE * int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_dir(spark, "chosen")
    column, asked = "parities" if only_parities else "shingles", rows.columns
    longs = ", ".join(f"{c} long" for c in asked)

    def stretch(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, object]]:
        for batch in batches:
            part = _part(batch["row"].to_numpy(), parts)
            yield {"part": part, **{c: batch[c] for c in asked}}

    dealt = by_task(rows, f"{longs}, part int", stretch).repartition("part")
    dealt.sortWithinPartitions("part").write.partitionBy("part").parquet(path)

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, object]]:
        system, base = folder_of(path)
        at, wanted, reader = -1, {}, None
        for batch in batches:
            row = batch["row"].to_numpy()
            part = _part(row, parts)
            times, first, held, n = np.zeros_like(row), np.zeros_like(row), [], 0
            edges = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
            for a, b in zip(edges.tolist(), edges[1:].tolist()):
                if part[a] != at:
                    at, wanted = int(part[a]), _rows_of(system, f"{base}/part={part[a]}", asked)
                low = np.searchsorted(wanted["row"], row[a:b])
                times[a:b] = np.searchsorted(wanted["row"], row[a:b], "right") - low
                first[a:b] = n + low
                held.append(wanted)
                n += len(wanted["row"])
            keep = times > 0
            times, first = times[keep], first[keep]
            here = {c: np.concatenate([h[c] for h in held]) for c in asked if held}
            kept = batch.filter(pa.array(keep))
            place = kept["place"].to_numpy()
            # A task may read a file in pieces, in any order.
            file = kept["file"].dictionary_encode()
            new = (np.diff(file.indices.to_numpy()) != 0) | (np.diff(place) <= 0)
            edges = [0, *(np.flatnonzero(new) + 1).tolist(), len(place)] if len(place) else []
            for a, b in zip(edges, edges[1:]):
                name = file[a].as_py()
                if reader is None or name != reader.name or place[a] < reader.first:
                    reader = _SetReader(name)
                for found in reader.of(place[a:b]):
                    made = pa.array([*parities(found)], pa.list_(pa.int64())) if only_parities else found
                    own, start = times[a : a + len(found)], first[a : a + len(found)]
                    a += len(found)
                    which = np.repeat(np.arange(len(found)), own)
                    index = np.arange(len(which)) + np.repeat(start - (np.cumsum(own) - own), own)
                    for some in range(0, len(which), ROWS):
                        said = index[some : some + ROWS]
                        values = made.take(pa.array(which[some : some + ROWS]))
                        yield {column: values, **{c: here[c][said] for c in asked}}

    places = sets.select("row", "_metadata.file_path", F.col("_metadata.row_index").cast("long"))
    return by_task(places.toDF("row", "file", "place"), f"{longs}, {column} array<long>", convert)


class _SetReader:
    """The sets of a file by their places, which are asked for in order."""

    def __init__(self, name: str):
        self.name, self.first = name, 0
        system, path = folder_of(name)
        self.file = pq.ParquetFile(system.open_input_file(path), buffer_size=BUFFER)
        rows = [self.file.metadata.row_group(g).num_rows for g in range(self.file.num_row_groups)]
        self.ends, self.group = np.cumsum(rows), -1

    def of(self, places: np.ndarray) -> Iterator[pa.Array]:
        """Some at a time. ``first`` is the first place that may be asked for next."""
        while len(places):
            group = int(np.searchsorted(self.ends, places[0], "right"))
            if group != self.group:
                self.group, self.first = group, int(self.ends[group - 1]) if group else 0
                self.batches = self.file.iter_batches(ROWS, row_groups=[group], columns=["shingles"])
                self.held = next(self.batches)["shingles"]
            n = int(np.searchsorted(places, self.first + len(self.held)))
            if n:
                yield self.held.take(pa.array(places[:n] - self.first))
                places = places[n:]
            else:
                self.first += len(self.held)
                self.held = next(self.batches)["shingles"]


def _part(numbers: np.ndarray, parts: int) -> np.ndarray:
    """Rows that follow each other in a task's file share a part, thousands at a time."""
    stretch = gathered(numbers).view(np.uint64) >> np.uint64(STRETCH_BITS)
    mixed = (stretch * _MIX) >> np.uint64(32)
    return (mixed % np.uint64(parts)).astype(np.int64)


def _rows_of(system: fs.FileSystem, folder: str, columns: list[str]) -> dict[str, np.ndarray]:
    """The rows of a part, none if nobody wrote it, by ``row``."""
    found = {c: [np.zeros(0, np.int64)] for c in columns}
    for info in system.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
        if info.path.endswith(".parquet"):
            with system.open_input_file(info.path) as opened:
                table = pq.ParquetFile(opened).read(columns)
                for c in columns:
                    found[c].append(table[c].to_numpy())
    rows = {c: np.concatenate(x) for c, x in found.items()}
    order = np.argsort(rows["row"], kind="stable")
    return {c: x[order] for c, x in rows.items()}


def _alike_in_size(a: str, b: str, percent: int):
    """Sets of these sizes can be similar enough."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _parities_allow(percent: int) -> Column:
    """A pair's parities do not refuse it: ``both`` of sizes n and m have (n + m - d) / 2 in common, d in
    just one of them, and parities differ at most d times."""
    apart = [F.bit_count(F.col("parities")[i].bitwiseXOR(F.col("hub_parities")[i])) for i in range(PARITIES)]
    return (100 + percent) * reduce(add, apart) <= (100 - percent) * (F.col("n") + F.col("hub_n"))


def confirmed(edges: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the edges (``a``, ``b``, ``slots``) whose full sets are similar enough.

    Only sets with an edge are moved: that of ``b`` once for each of its edges, as it is read, to where it
    meets that of ``a``. The set of a hub with very many edges goes to ``slots`` tasks, which
    share its edges.
    """
    slot = F.pmod(F.xxhash64("b"), "slots").alias("slot")
    others = chosen(sets, edges.select(F.col("b").alias("row"), "a", slot))
    hubs = edges.groupBy("a").agg(F.max("slots").alias("slots"))
    ones = chosen(sets, hubs.select(F.col("a").alias("row"), "slots"))
    ones = ones.select(
        F.col("row").alias("a"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1)).alias("slot"),
        F.col("shingles").alias("one"),
    )
    pairs = others.withColumnsRenamed({"row": "b", "shingles": "other"}).join(ones, ["a", "slot"])
    both = F.size(F.array_intersect("one", "other")).cast("long")
    sized = pairs.select("a", "b", both.alias("both"), (F.size("one") + F.size("other")).alias("sum"))
    return sized.filter(100 * F.col("both") >= percent * (F.col("sum") - F.col("both"))).select("a", "b")


def _edges(members: DataFrame, hubs: DataFrame, bits: DataFrame, percent: int, first: bool) -> DataFrame:
    """Distinct edges of hubs and members of their buckets, a row each at most, without those that
    sizes or parities refuse. The first hubs have no more pairs than there are members, and
    most of these in many buckets, so that parities are asked for distinct pairs; later they
    refuse pairs in the join that makes them."""
    hub_bits = bits.toDF("hub", "hub_parities")
    if not first:
        members, hubs = members.join(bits, "rep"), hubs.join(hub_bits, "hub")
    others = (F.col("root") != F.col("hub_root")) & (F.struct("rank", "rep") > F.col("hub_turn"))
    fits = members.join(hubs, "key").filter(others & _alike_in_size("n", "hub_n", percent))
    if not first:
        fits = fits.filter(_parities_allow(percent))
    slots = F.max(F.ceil(F.col("size") / EDGES)).cast("long").alias("slots")
    edges = fits.groupBy("hub", "rep", "n", "hub_n").agg(slots)
    if first:
        edges = edges.join(bits, "rep").join(hub_bits, "hub").filter(_parities_allow(percent))
    return edges.select(F.col("hub").alias("a"), F.col("rep").alias("b"), "slots")


def _may_link(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``rep`` of those members (``rep``, ``n``, ``root``) that may be similar to one of another
    component: at least ``percent`` of their shingles are in a set of another one, as all that a
    link has in common are. Shingles are counted before they are shuffled."""
    some = chosen(sets, members.select(F.col("rep").alias("row")))
    rows = some.select(F.col("row").alias("rep"), F.explode("shingles").alias("shingle"))
    rows = written(rows.join(members, "rep"), "shingles")
    shared = rows.groupBy("shingle").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    shared = shared.filter("low < high").select("shingle")
    counts = rows.join(shared, "shingle").groupBy("rep", "n").agg(F.count(F.lit(1)).alias("common"))
    return counts.filter(100 * F.col("common") >= percent * F.col("n")).select("rep")


def _crowded(distinct: DataFrame) -> DataFrame:
    """``key``, ``rep`` and ``size`` of the buckets with several sets (``rep``, ``keys``). Most buckets
    have one only; all members are moved once, to be counted and to meet their count."""
    every = distinct.select("rep", F.explode("keys").alias("key")).repartition("key")
    # Counts that read all columns share the exchange of the members.
    ends = [F.min("rep").alias("low"), F.max("rep").alias("high")]
    sizes = every.groupBy("key").agg(F.count(F.lit(1)).alias("size"), *ends).filter("low < high")
    return every.join(sizes.select("key", "size"), "key")


def linked(distinct: DataFrame, sets: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Confirmed links (``a``, ``b``) between sets (``rep``, ``n``, ``keys``), enough to connect all that
    share a bucket and are similar enough, directly or over others; and their components
    (``rep``, ``root``), of sets with a link."""
    spark = distinct.sparkSession
    crowded = written(_crowded(distinct), "buckets")
    # Members in the order in which they become hubs: those who meet most others first.
    met = crowded.groupBy("rep").agg((-F.sum("size")).alias("rank"))
    met = met.join(distinct.select("rep", "n"), "rep")
    crowded = written(crowded.join(met, "rep"), "buckets")
    bits = chosen(sets, crowded.select(F.col("rep").alias("row")).distinct(), only_parities=True)
    bits = written(bits.withColumnRenamed("row", "rep"), "parities")
    found = tried = spark.createDataFrame([], "a long, b long")
    roots, n_hubs = spark.createDataFrame([], "rep long, root long"), 1
    placed = crowded.withColumn("root", F.col("rep"))
    lowest = Window.partitionBy("key").orderBy("rank", "rep")
    turn = F.struct("rank", "rep")
    while True:
        # Each task sends no more members of a bucket than are to be hubs.
        hubs = placed.withColumn("at", F.row_number().over(lowest)).filter(F.col("at") <= n_hubs)
        hubs = written(
            hubs.select(
                "key", F.col("rep").alias("hub"), F.col("n").alias("hub_n"),
                F.col("root").alias("hub_root"), turn.alias("hub_turn"),
            ),
            "hubs",
        )
        edges = _edges(placed, hubs, bits, percent, n_hubs == 1)
        new = written(edges.join(tried, ["a", "b"], "left_anti"), "edges")
        more = written(confirmed(new, sets, percent), "links")
        found, tried = found.union(more), tried.union(new.select("a", "b"))
        if not more.isEmpty():
            # What is connected already is a star of its root.
            stars = roots.filter("rep != root").toDF("a", "b")
            roots = written(connected(stars.union(more)).toDF("rep", "root"), "roots")
        # Hubs have met all of their bucket.
        cut = hubs.groupBy("key").agg(F.max("hub_turn").alias("cut"))
        left = crowded.join(cut, "key").filter(turn > F.col("cut")).drop("cut")
        left = left.join(roots, "rep", "left").withColumn("root", F.coalesce("root", "rep"))
        placed = _open(written(left, "left"))
        n_hubs *= MORE_HUBS
        if n_hubs >= MANY_HUBS:
            placed = written(placed, "open-members")
            some = placed.select("rep", "n", "root").distinct()
            alive = written(_may_link(some, sets, percent), "may-link")
            placed = _open(written(placed.join(alive, "rep"), "left"))
        placed = written(placed, "open-buckets")
        if placed.isEmpty():
            return found, roots
        crowded = placed.drop("root")


def _open(left: DataFrame) -> DataFrame:
    """Members of buckets whose members lie in several components."""
    ends = left.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    return left.join(ends.filter("low < high").select("key"), "key")


def near_copies(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` of every document.

    Documents link if at least ``percent`` of the shingles that either has are in both;
    ``component_id`` is the smallest ``doc_id`` reachable, ``kept`` says that it is the document's
    own. Reads ``doc_id`` and ``text`` only. Null and empty texts have no shingles and are
    their own component, rows alike in them included; other rows alike are one set, with one
    component. A null ``doc_id`` is never the smallest unless all are null, which gives null and
    ``kept``. No documents give no rows. Copies meet as one set before anything is compared. Sets
    are told apart by 128 bits and shingles by 64 bits of hash.
    """
    sets = written(sets_of(docs, size), "sets")
    distinct = written(
        sets.filter("n_shingles > 0")
        .groupBy("set_key", "keys", F.col("n_shingles").alias("n"))
        .agg(F.min("row").alias("rep"), F.min("doc_id").alias("least")),
        "distinct-sets",
    )
    _, roots = linked(distinct.select("rep", "n", "keys"), sets, percent)
    classes = distinct.join(roots, "rep", "left").select(
        "set_key", F.coalesce("root", "rep").alias("root"), "least"
    )
    least = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    components = classes.join(least, "root").select("set_key", "component_id")
    rows = sets.select("doc_id", "n_shingles", "set_key")
    some = rows.filter("n_shingles > 0").join(components, "set_key")
    none = rows.filter("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    return some.unionByName(none).select(
        "doc_id", "n_shingles", "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from corpus_cases import clean, lower, multiset, prose, rows, table

from pointloom.llm import near_copies


def plain_set(text):
    words = clean(lower(text or ""))
    if len(words) < 2:
        return frozenset([" ".join(words)]) if words else frozenset()
    return frozenset(" ".join(words[i : i + 2]) for i in range(len(words) - 1))


def similar(a, b):
    return bool(a) and 100 * len(a & b) >= 80 * len(a | b)


def components(sets):
    label = list(range(len(sets)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if len(a) <= 1.25 * len(sets[j]) and len(sets[j]) <= 1.25 * len(a) and similar(a, sets[j]):
                x, y = find(i), find(j)
                label[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(sets))]


def plain(made):
    sets = [plain_set(r[1]) for r in made]
    label = components(sets)
    least = {}
    for row, c in zip(made, label):
        if row[0] is not None:
            least[c] = min(least.get(c, row[0]), row[0])
    return [(r[0], len(s), least.get(c), r[0] == least.get(c)) for r, s, c in zip(made, sets, label)]


def varied(seed):
    """Chains of small edits, templates, copies in other case, short texts."""
    rng = random.Random(seed)
    texts = []
    for _ in range(12):
        words = prose(rng, rng.choice([3, 8, 30, 120, 400])).split()
        for _ in range(rng.randrange(1, 9)):
            texts.append(" ".join(words))
            for _ in range(max(1, len(words) // 25)):
                words[rng.randrange(len(words))] = f"x{rng.randrange(1000)}"
    texts += [texts[0].upper(), f" {texts[1]}\n", "a b", "a  b", "a b a b", "b a"]
    made = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    rng.shuffle(made)
    return made


@pytest.mark.parametrize("made", [rows(), rows(5), varied(1), varied(2)])
def test_equals_brute_force(spark, made):
    found = near_copies.near_copies(table(spark, made)).collect()
    assert multiset(map(tuple, found)) == multiset(plain(made))


def test_no_documents(spark):
    assert near_copies.near_copies(table(spark, [])).collect() == []


def test_template_gives_a_star_and_no_pairs(spark):
    base = prose(random.Random(7), 200).split()
    made = [(i, " ".join([*base[:i], f"new{i}", *base[i + 1 :]]), "en", "s", 1) for i in range(200)]
    sets = near_copies.written(near_copies.sets_of(table(spark, made)), "sets")
    distinct = sets.selectExpr("row AS rep", "n_shingles AS n", "keys")
    links, _ = near_copies.linked(distinct, sets)
    assert links.count() < 10 * len(made)
    found = near_copies.near_copies(table(spark, made)).collect()
    assert {r["component_id"] for r in found} == {0} and sum(r["kept"] for r in found) == 1


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_no_link_of_a_bucket_is_lost(spark, seed):
    """All sets in one bucket, most of them unlike its first hubs."""
    rng = random.Random(seed)
    sets = []
    for g in range(14):
        base = [g * 1000 + i for i in range(rng.choice([5, 20, 40]))]
        for _ in range(rng.randrange(1, 6)):
            sets.append(frozenset(base))
            base[rng.randrange(len(base))] = g * 1000 + 500 + rng.randrange(400)
    sets = sorted(set(sets), key=sorted)
    rng.shuffle(sets)
    numbers = near_copies.spread(np.arange(len(sets))).tolist()
    made = [(r, len(s), list(range(32)), sorted(s)) for r, s in zip(numbers, sets)]
    schema = "row long, n long, keys array<long>, shingles array<long>"
    df = near_copies.written(spark.createDataFrame(made, schema), "sets")
    distinct = df.withColumnRenamed("row", "rep").select("rep", "n", "keys")
    links, roots = near_copies.linked(distinct, df)
    at = {r: i for i, r in enumerate(numbers)}
    label = list(range(len(sets)))
    links = [(at[a], at[b]) for a, b in links.collect()]
    assert all(similar(sets[a], sets[b]) for a, b in links)
    for _ in sets:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    assert label == components(sets)
    groups = {r["rep"]: r["root"] for r in roots.collect()}
    assert len({groups.get(r, r) for r in numbers}) == len(set(label))


@pytest.mark.parametrize("first", [1, 16])
def test_no_link_is_lost_when_shingles_are_counted_early(spark, monkeypatch, first):
    monkeypatch.setattr(near_copies, "MANY_HUBS", first)
    monkeypatch.setattr(near_copies, "MORE_HUBS", 2)
    test_no_link_of_a_bucket_is_lost(spark, 4)


def test_unlike_mixes_of_passages_are_not_compared_in_pairs(spark, monkeypatch):
    """Documents all of whose words are in others, half of them in all, with similarities below 0.8."""
    rng = random.Random(11)
    half = prose(rng, 120)
    passages = [prose(rng, 40) for _ in range(12)]
    texts = [" ".join([half, *rng.sample(passages, 3)]) for _ in range(120)]
    made = [(i, t, "en", "s", 1) for i, t in enumerate([*texts, texts[0] + " more"])]
    edges, confirmed = [], near_copies.confirmed

    def counted(some, sets, percent):
        edges.append(some.count())
        return confirmed(some, sets, percent)

    monkeypatch.setattr(near_copies, "confirmed", counted)
    found = near_copies.near_copies(table(spark, made)).collect()
    assert multiset(map(tuple, found)) == multiset(plain(made))
    assert 0 < sum(edges) < 2 * len(made)


def test_parities_refuse_no_similar_pair():
    rng = np.random.default_rng(3)
    for n in (1, 5, 40, 300, 3000):
        pool = rng.integers(-(1 << 63), 1 << 63, 3 * n, np.int64)
        sets = [np.unique(pool[at : at + n]) for at in range(0, 2 * n, max(1, n // 12))]
        bits = near_copies.parities(pa.array(sets, pa.list_(pa.int64())))
        assert bits.shape == (len(sets), near_copies.PARITIES)
        refused = 0
        for a, x in zip(sets, bits):
            for b, y in zip(sets, bits):
                apart = len(np.setxor1d(a, b))
                differ = int(np.bitwise_count((x ^ y).view(np.uint64)).sum())
                assert differ <= apart and (apart - differ) % 2 == 0
                refused += 9 * differ > len(a) + len(b)
        assert refused > len(sets) or n in (1, 3000)


def test_chosen_sets_are_read_in_small_batches(spark, monkeypatch):
    """Only numbers and places of rows go to the tasks' Python, whichever the sets that are asked for."""
    made = [(i, f"w{i} " * (i % 5) + f"v{i % 97} u{i} t{i % 7}", "en", "s", 1) for i in range(5000)]
    sets = near_copies.written(near_copies.sets_of(table(spark, made).coalesce(2)), "sets")
    every = {r["row"]: r["shingles"] for r in sets.collect()}
    seen, by_task = [], near_copies.by_task

    def noted(df, schema, convert):
        seen.append((df.columns, schema))
        return by_task(df, schema, convert)

    monkeypatch.setattr(near_copies, "by_task", noted)
    numbers = sorted(every)
    for some in ([], numbers[:1], numbers[::7], numbers[1000:1100], numbers):
        rows = spark.createDataFrame([(n,) for n in some], "row long")
        found = near_copies.chosen(sets, rows).collect()
        assert {r["row"]: r["shingles"] for r in found} == {n: every[n] for n in some}
        assert len(found) == len(some)
    assert all("shingles" not in columns for columns, _ in seen)


def test_sets_of_a_file_are_read_by_their_places(tmp_path):
    sets = [list(range(i, i + i % 4)) for i in range(5000)]
    path = f"{tmp_path}/sets.parquet"
    pq.write_table(pa.table({"shingles": pa.array(sets, pa.list_(pa.int64()))}), path, row_group_size=1300)
    for asked in ([0], [4999], [1299, 1300], range(5000), range(3, 5000, 1024), range(1023, 1400), [7, 3900, 3999]):
        reader, asked, found = near_copies._SetReader(f"file://{path}"), list(asked), []
        for a in range(0, len(asked), 600):
            found += [x for some in reader.of(np.array(asked[a : a + 600])) for x in some.to_pylist()]
        assert found == [sets[i] for i in asked]


def test_rows_come_back_from_their_numbers():
    rows = np.array([0, 1, 5 * near_copies.TASK + 7, near_copies.TASK * 900_000])
    assert (near_copies.gathered(near_copies.spread(rows)) == rows).all()


def test_densification_is_that_of_drawing_again_and_again():
    rng = np.random.default_rng(5)
    for n in (1, 2, 17, 300):
        hashes = np.unique(rng.integers(0, 1 << 64, n, np.uint64, endpoint=False))
        bins = [int(h) * near_copies.BINS >> 64 for h in hashes]
        least = {b: min(h for h, c in zip(hashes, bins) if c == b) for b in set(bins)}
        values = near_copies.bin_values(hashes)
        for b in range(near_copies.BINS):
            asked = sorted(range(near_copies.BINS), key=lambda x: near_copies._RANK[b, x])
            source = b if b in least else next(x for x in asked if x in least)
            assert values[b] == least[source]


def test_bands_meet_as_often_as_similar_sets_do():
    rng = np.random.default_rng(9)
    met = []
    for _ in range(300):
        pool = rng.integers(0, 1 << 64, 110, np.uint64, endpoint=False)
        a, b = np.unique(pool[:100]), np.unique(pool[10:])  # 90 of 110 in both
        same = near_copies.band_keys(near_copies.bin_values(a)) == near_copies.band_keys(
            near_copies.bin_values(b)
        )
        met.append(same.mean())
    assert abs(np.mean(met) - (90 / 110) ** near_copies.VALUES) < 0.05
    assert min(met) > 0


def test_members_of_buckets_are_moved_once(spark):
    """Counts and members of all buckets, most of which have one member, share an exchange."""
    made = [(i, 5, [i // 3, 1000 + i, 2000 + i % 2]) for i in range(300)] + [(300, 1, [9999])]
    distinct = near_copies.written(spark.createDataFrame(made, "rep long, n long, keys array<long>"), "x")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        crowded = near_copies._crowded(distinct).select("key", "rep", "size")
        found = crowded.collect()
        plan = crowded._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    wanted = [(i // 3, i, 3) for i in range(300)] + [(2000 + i % 2, i, 150) for i in range(300)]
    assert multiset(map(tuple, found)) == multiset(wanted)
    assert plan.count("Generate explode") == 1 and plan.count("ReusedExchange") == 1


def test_sets_come_once_for_each_of_their_rows(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "ROWS", 64)
    made = [(i, f"w{i} " * (i % 5) + f"v{i % 97} u{i}", "en", "s", 1) for i in range(1500)]
    sets = near_copies.written(near_copies.sets_of(table(spark, made).coalesce(2)), "sets")
    every = {r["row"]: r["shingles"] for r in sets.collect()}
    numbers = sorted(every)
    asked = [(n, at, k) for at, n in enumerate(numbers[::9]) for k in range(at % 4)]
    asked += [(numbers[5], -1, k) for k in range(700)]
    rows = spark.createDataFrame(asked, "row long, a long, slot long").repartition(3)
    found = near_copies.chosen(sets, rows).collect()
    assert multiset((r["row"], r["a"], r["slot"]) for r in found) == multiset(asked)
    assert all(r["shingles"] == every[r["row"]] for r in found)


def test_parities_refuse_the_same_pairs_of_first_hubs_and_of_later_ones(spark):
    rng = np.random.default_rng(4)
    pool = rng.integers(-(1 << 63), 1 << 63, 200, np.int64)
    sets = [np.sort(rng.choice(pool[: 52 + 3 * (i % 9)], 50 + 3 * (i % 9), False)) for i in range(90)]
    bits = near_copies.parities(pa.array(sets, pa.list_(pa.int64()))).tolist()
    bits = spark.createDataFrame(list(enumerate(bits)), "rep long, parities array<long>")
    made = [(k, i, len(x), -5, 90, i) for i, x in enumerate(sets) for k in range(i % 9, 9, 2)]
    schema = "key long, rep long, n long, rank long, size long, root long"
    members = spark.createDataFrame(made, schema)
    hubs = members.filter("rep = key").selectExpr(
        "key", "rep AS hub", "n AS hub_n", "root AS hub_root", "struct(rank, rep) AS hub_turn"
    )
    edges = [near_copies._edges(members, hubs, bits, 80, first).collect() for first in (True, False)]
    assert multiset(map(tuple, edges[0])) == multiset(map(tuple, edges[1]))
    assert 0 < len(edges[0]) < 9 * 81

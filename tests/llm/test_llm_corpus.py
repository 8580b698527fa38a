"""Archives, fingerprints, decontamination, mixing."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import time
from fractions import Fraction

import numpy as np
import pytest
import xxhash
from corpus_cases import SCHEMA, clean, lower, multiset, prose, rows, table
from pyspark.sql import functions as F

from pointloom.llm import minhash, mixing, positional, warc
from pointloom.llm.catalogue import QUERIES
from pointloom.llm.common import written

PAGES = "page_id long, url string, html string"


def pages():
    rng = random.Random(4)
    big = prose(rng, 400) + "é\r\n\r\nWARC/1.1\r\n"
    made = [(i, f"http://h{i % 4}.example.com/p/{i % 17}?q={i}", prose(rng, 300)) for i in range(60)]
    made += [(100 + i, f"https://Hot.Example.com:443/x{i}", big) for i in range(25)]
    made += [(200 + i, "http://same.org/", big if i % 2 else prose(rng, 250)) for i in range(40)]
    made += [(300, "http://a/", "x" * 999), (301, "http://b/", "x" * 999)]
    made += [(302, "http://a/", "y" * 1000), (303, "http://b/", "y" * 1000)]
    made += [(304, None, None), (305, "", ""), (None, "http://n/", big), (None, None, "z" * 2000)]
    made += [(306, "no scheme \t\n x", "é" * 600), (307, "http://u:p@[x", "é" * 600)]
    made += [made[0], (302, "http://a/", "y" * 1000)]
    return made


def page_table(spark, made, parts=6):
    plain = spark.createDataFrame(made, PAGES).repartition(parts)
    return plain.select("*", F.lit("clash").alias("URL"))


def plain_archive(made):
    leader = {}
    for page_id, _, html in made:
        if page_id is not None:
            leader[html] = max(leader.get(html, page_id), page_id)
    for page_id, _, html in made:
        payload = (html or "").encode()
        top = leader.get(html)
        shared = len(payload) >= 1000 and top is not None and page_id != top
        yield (page_id, len(payload), hashlib.sha1(payload).hexdigest(),
               "revisit" if shared else "response", top if shared else None)


def test_archives_return_every_page(spark):
    made = pages()
    table = page_table(spark, made)
    index = warc.archived(table)
    found = warc.read_records(index, warc.lookup(index, warc.keys_of(table)))
    assert multiset(map(tuple, found.collect())) == multiset(plain_archive(made))


def test_lookup_finds_just_the_captures_of_a_key(spark):
    made = pages()
    index = warc.archived(page_table(spark, made))
    keys = [("org,same)/",), ("com,example,hot)/x3",), ("com,example,nowhere)/",), (None,), ("",), ("",)]
    found = warc.lookup(index, spark.createDataFrame(keys, "key string")).collect()
    expected = [warc.url_key(url) for _, url, _ in made]
    for key in {k for (k,) in keys}:
        assert sum(r["key"] == key for r in found) == (0 if key is None else expected.count(key))


def test_blocks_of_a_key_that_fills_many():
    firsts = [b"a", b"c", b"m", b"m", b"m", b"t"]
    assert list(warc._blocks_with(firsts, b"m")) == [1, 2, 3, 4]
    assert list(warc._blocks_with(firsts, b"b")) == [0]
    assert list(warc._blocks_with(firsts, b"z")) == [5]
    assert list(warc._blocks_with(firsts, b"A")) == []


@pytest.mark.parametrize(
    ("url", "key"),
    [
        ("http://www.Example.com/A/b?x=1#f", "com,example,www)/A/b?x=1"),
        ("HTTPS://u:p@example.com:443", "com,example)/"),
        ("http://example.com:8080/", "com,example:8080)/"),
        ("http://example.com?x", "com,example)?x"),
        ("mailto:a b", "mailto:a%20b"),
        (None, ""),
    ],
)
def test_url_keys(url, key):
    assert warc.url_key(url) == key


def test_damage_is_noticed():
    page = {"page_id": 1, "url": "http://a/", "payload": b"abc", "kind": "response",
            "digest": hashlib.sha1(b"abc").hexdigest(), "refers_to": None}
    data = warc.record(page)
    assert warc.parse(data)["payload_bytes"] == 3
    with pytest.raises(ValueError, match="damaged"):
        warc.parse(data.replace(b"abc", b"abd"))


def test_no_pages(spark):
    index = warc.archived(page_table(spark, []))
    keys = spark.createDataFrame([("a",)], "key string")
    assert index.shards == [] and warc.lookup(index, keys).collect() == []


# Fingerprints


def shingles(text):
    words = clean(text)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_neighbours_over_all_partitions(spark):
    made = rows()
    found = minhash.compared_with_next(table(spark, made)).collect()
    assert len(found) == len(made)
    ids = [r for r in made if r[0] is not None and r[0] != 5 and r[0] not in (3, 10)]
    order = sorted(ids, key=lambda r: -r[0])
    by_id = {r["doc_id"]: r for r in found}
    for one, following in itertools.pairwise(order):
        if any(following[0] < i < one[0] for i in (3, 5, 10)) or following[0] == -4:
            continue
        text, other = one[1] or "", following[1] or ""
        third = len(text) // 3
        changed = text[: len(text) - third] + other[:third]
        row = by_id[one[0]]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert row["fingerprint"] == minhash.fingerprint(text)
        assert row["near_edited"] == minhash.likeness(minhash.fingerprint(text), minhash.fingerprint(changed))
        assert row["near_next"] == minhash.likeness(minhash.fingerprint(text), minhash.fingerprint(other))


def test_ring_of_all_sizes(spark):
    for n in (0, 1, 2, 7):
        made = [(i, f"text {i} " * 9, "en", "s", 1) for i in range(n)]
        found = {r["doc_id"]: r["edited_sha256"] for r in minhash.compared_with_next(table(spark, made)).collect()}
        for i in range(n):
            changed = minhash.edited(made[i][1], made[(i - 1) % n][1])
            assert found[i] == hashlib.sha256(changed.encode()).hexdigest()


def test_likeness_is_that_of_the_shingles():
    rng = random.Random(12)
    errors = []
    for n in (8, 20, 60, 200, 800):
        for kept in (0, 0.3, 0.6, 0.9):
            for _ in range(12):
                a = prose(rng, n, 5000)
                words = a.split()
                cut = int(n * kept)
                b = " ".join([*words[:cut], *prose(rng, n - cut, 5000).split()])
                x, y = shingles(a), shingles(b)
                likeness = minhash.likeness(minhash.fingerprint(a), minhash.fingerprint(b))
                errors.append(likeness - len(x & y) / len(x | y))
    assert abs(np.mean(errors)) < 0.02 and np.sqrt(np.mean(np.square(errors))) < 0.08


def test_fingerprints_of_small_texts():
    assert minhash.fingerprint("") == minhash.fingerprint(" \n") == b""
    assert minhash.likeness(b"", b"") == 1.0 and minhash.likeness(b"", minhash.fingerprint("a")) == 0
    one, other = minhash.fingerprint("a b"), minhash.fingerprint("a c")
    assert len(one) == minhash.BINS // 2 and minhash.likeness(one, one) == 1.0
    assert minhash.likeness(one, other) < 0.15


# Decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def folded(text):
    return WORD.findall(lower(text or ""))


def plain_hits(made, items, size=10):
    windows = {}
    for item_id, text in items:
        words = folded(text)
        for i in range(max(len(words) - size, 0) + 1 if words else 0):
            windows.setdefault(tuple(words[i : i + size]), set()).add(item_id)
    for row in made:
        words, hit, found = folded(row[1]), set(), set()
        for i in range(len(words)):
            for n in {len(w) for w in windows}:
                if i + n <= len(words) and tuple(words[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(words[i : i + n])]
        ids = sorted(str(x) for x in found if x is not None)
        yield row[0], len(words), len(hit), len(found), ids


def benchmark(made):
    rng = random.Random(13)
    words = made[12][1].split()
    items = [(i, " ".join(words[i * 50 : i * 50 + 14 + i])) for i in range(12)]
    items += [(50, "Word"), (51, " - "), (52, None), (53, ""), (None, " ".join(words[900:915]))]
    items += [(7, "Öl SS"), (7, made[0][1][:60].upper()), (60, prose(rng, 30)), items[0]]
    items += [(70, "loop " * 12), (71, "Ä ß! x-y")]
    return items


def benchmark_table(spark, items):
    plain = spark.createDataFrame(items, "item_id long, text string")
    return plain.select("*", F.lit("clash").alias("TEXT"))


def test_contamination_equals_brute_force(spark):
    made = [*rows(), (800, "hit öl ss end", "de", "s", 1), (801, "öL (SS)", "de", "s", 1)]
    items = benchmark(made)
    index = positional.build_index(table(spark, made))
    found = positional.contaminated(index, benchmark_table(spark, items)).collect()
    assert multiset(map(tuple, found)) == multiset(plain_hits(made, items))


def test_benchmark_in_many_blocks_gives_the_same(spark):
    made = rows()
    items = benchmark(made)
    index = positional.build_index(table(spark, made))
    segments = [positional.unpack(r.asDict()) for r in index.collect()]
    whole = positional.windows_of([(i, (t or "").encode()) for i, t in items], 10)
    single = [positional.windows_of([(i, (t or "").encode())], 10) for i, t in items]

    def places(windows):
        return {
            (s, int(b), n) for s, segment in enumerate(segments)
            for w in windows for begins, n, _ in positional.phrases(segment, w) for b in begins
        }

    assert places([whole]) == places(single)


def test_clean_documents_stay(spark):
    made = rows()
    items = benchmark(made)
    docs, bench = table(spark, made), benchmark_table(spark, items)
    hit = [r for r, h in zip(made, plain_hits(made, items)) if h[2]]
    kept = positional.keep_clean(docs, bench)
    assert kept.columns == docs.columns
    assert multiset(tuple(r)[:5] for r in kept.collect()) == multiset(r for r in made if r not in hit)
    assert 0 < len(hit) < len(made)


def test_nothing_to_match(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    made = rows()
    index = positional.build_index(table(spark, made))
    assert {r["n_hit"] for r in positional.contaminated(index, none).collect()} == {0}
    empty = positional.build_index(table(spark, []))
    assert positional.contaminated(empty, none).collect() == []


def test_proximity_equals_brute_force(spark):
    made = [(i, prose(random.Random(i), 60, 12), "en", "s", 1) for i in range(8)]
    items = [(1, "w1 w2 w3"), (2, "w4 w4 w5 w6"), (3, "w99 w1")]
    index = positional.build_index(table(spark, made))
    found = positional.proximity(index, benchmark_table(spark, items), size=3, slop=2).collect()
    expected = set()
    for doc_id, text, *_ in made:
        words = text.split()
        for item_id, item in items:
            query = item.split()
            for j in range(max(len(query) - 3, 0) + 1):
                wanted = set(query[j : j + 3])
                span = len(query[j : j + 3]) + 2
                for i, word in enumerate(words):
                    if word in wanted and wanted <= set(words[i : i + span]):
                        expected.add((doc_id, str(item_id), i, span))
    assert {tuple(r) for r in found} == expected and expected


# Mixing


def plain_targets(sizes, weights):
    """Share, cut, share the excess anew, until nothing is above."""
    target = [Fraction(3, 2) * sum(sizes) * w / sum(weights) for w in weights]
    while any(t > 2 * s for t, s in zip(target, sizes)):
        excess = sum(t - 2 * s for t, s in zip(target, sizes) if t > 2 * s)
        target = [min(t, Fraction(2 * s)) for t, s in zip(target, sizes)]
        open_ = [i for i, (t, s) in enumerate(zip(target, sizes)) if t < 2 * s]
        total = sum(weights[i] for i in open_)
        for i in open_:
            target[i] += excess * weights[i] / total
    return target


@pytest.mark.parametrize("seed", range(6))
def test_targets(seed):
    rng = random.Random(seed)
    sizes = [rng.choice((0, 1, 10, 500, 9000)) for _ in range(rng.randrange(1, 9))]
    weights = [(3, 1, 2)[i % 3] for i in range(len(sizes))]
    assert mixing.targets(sizes, weights, Fraction(3, 2), 2) == plain_targets(sizes, weights)


def test_mix_comes_near_the_targets_and_repeats(spark):
    made = rows()
    found = mixing.mixed(table(spark, made)).collect()
    assert len(found) == len(made)
    assert multiset((r["doc_id"], r["size"]) for r in found) == multiset((r[0], len(clean(r[1]))) for r in made)
    names = sorted({r[3] for r in made}, key=lambda s: (s is None, s or ""))
    sizes = [sum(len(clean(r[1])) for r in made if r[3] == n) for n in names]
    wanted = plain_targets(sizes, [(3, 1, 2)[i % 3] for i in range(len(names))])
    for size, target in zip(sizes, wanted):
        mine = [r for r in found if r["source_size"] == size]
        assert {r["target"] for r in mine} == {float(target)}
        assert abs(sum(r["taken"] for r in mine) - target) <= 1
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in found)
    partial = [r for r in found if r["size"] and r["taken"] % r["size"]]
    assert len(partial) <= len(names)
    again = mixing.mixed(table(spark, made, parts=2)).collect()
    assert multiset(again) == multiset(found)


def test_no_documents_to_mix(spark):
    assert mixing.mixed(table(spark, [])).collect() == []


def cost(flow, size):
    return sum(max(0, f - p * size) and min(f - p * size, size) * p for p in range(2) for f in [flow])


def test_flow_is_feasible_and_cheapest():
    rng = random.Random(14)
    for _ in range(40):
        n, m = rng.randrange(1, 4), rng.randrange(1, 3)
        sizes = [rng.randrange(0, 4) for _ in range(n)]
        members = [sorted(rng.sample(range(m), rng.randrange(1, m + 1))) for _ in range(n)]
        quotas = [rng.randrange(0, 5) for _ in range(m)]
        flow = mixing.min_cost_flow(sizes, members, quotas, 2)

        best = None
        options = [
            [c for c in itertools.product(range(5), repeat=len(members[i])) if sum(c) <= 2 * sizes[i]]
            for i in range(n)
        ]
        for choice in itertools.product(*options):
            met = [0] * m
            for i, c in enumerate(choice):
                for s, x in zip(members[i], c):
                    met[s] += x
            if all(a <= b for a, b in zip(met, quotas)):
                value = (-sum(met), sum(cost(sum(c), sizes[i]) for i, c in enumerate(choice)))
                best = value if best is None else min(best, value)
        assert (-sum(flow), sum(cost(f, s) for f, s in zip(flow, sizes))) == best


def test_flow_scales():
    """A source for each of 100,000 patterns, and 20,000 patterns that share 300 sources."""
    rng = random.Random(15)
    sizes = [rng.randrange(10_000) for _ in range(100_000)]
    begin = time.perf_counter()
    wanted = mixing.targets(sizes, [(3, 1, 2)[i % 3] for i in range(len(sizes))], Fraction(3, 2), 2)
    quotas = [round(w) for w in wanted]
    flow = mixing.min_cost_flow(sizes, [[i] for i in range(len(sizes))], quotas, 2)
    assert time.perf_counter() - begin < 10
    assert flow == [min(2 * z, q) for z, q in zip(sizes, quotas)]

    members = [sorted(rng.sample(range(300), rng.randrange(1, 4))) for _ in range(20_000)]
    quotas = [rng.randrange(1_000_000) for _ in range(300)]
    begin = time.perf_counter()
    flow = mixing.min_cost_flow(sizes[:20_000], members, quotas, 2)
    assert time.perf_counter() - begin < 20
    assert sum(flow) <= sum(quotas) and all(0 <= f <= 2 * z for f, z in zip(flow, sizes))


def test_equal_rows_are_mixed_in_many_tasks(spark):
    """Half of all rows alike: they are counted, and made again a few thousand at a time."""
    made = [(1, "a b c", "en", "s0", 5)] * 20_000 + [(i, "a b", "en", "s1", 3) for i in range(20_000)]
    docs = spark.createDataFrame(made, SCHEMA).repartition(4)
    for name, value in (("adaptive.coalescePartitions.enabled", "false"), ("shuffle.partitions", "16")):
        spark.conf.set(f"spark.sql.{name}", value)
    try:
        found = mixing.mix(mixing.of_documents(docs), ["doc_id", "text_hash"]).taken
        mine = found.filter("sources[0] = 's0'").withColumn("task", F.spark_partition_id())
        tasks = mine.groupBy("task").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(r["count"] for r in tasks) == 20_000
    assert max(r["count"] for r in tasks) <= 3 * mixing.COPIES
    taken = sorted(r["taken"] for r in mine.collect())
    assert sum(0 < t % 3 for t in taken) <= 1 and set(taken) <= {0, 3, 6, *(t for t in taken if t % 3)}


def test_equal_rows_are_compared_in_many_tasks(spark, monkeypatch):
    tables = []
    monkeypatch.setattr(minhash, "written", lambda *a: tables.append(written(*a)) or tables[-1])
    made = [(1, "a b c d e f", "en", "s0", 5)] * 3000 + [(i, f"a {i}", "en", "s1", 3) for i in range(3000)]
    docs = spark.createDataFrame(made, SCHEMA).repartition(4)
    found = minhash.compared_with_next(docs)
    assert found.count() == len(made)
    assert found.filter("doc_id = 1 AND near_next = 1").count() >= 2999
    files = tables[0].select(F.input_file_name().alias("file")).groupBy("file").count().collect()
    assert len(files) > 2 and max(r["count"] for r in files) < 3000  # no task had all copies


def test_query_equals_plain_fingerprints(spark, tmp_path):
    """Binning and densification with dictionaries, through the registered query."""
    made = [r for r in rows() if len(r[1] or "") < 5000]
    spark.createDataFrame(made, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op2_minhash"](spark, str(tmp_path)).collect()

    def plain(text):
        words = clean(text)
        shingles = {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
        least = {}
        for shingle in shingles:
            h = xxhash.xxh64_intdigest(shingle.encode(), 42)
            at = h >> 56
            least[at] = min(least.get(at, h), h)
        if not least:
            return ""
        digits = ""
        for at in range(256):
            source, attempt = at, 0
            while source not in least:
                source, attempt = int(minhash._draw(attempt)[at]), attempt + 1
            value = (least[source] ^ int(minhash._SPREAD[at])) * 0x9E3779B97F4A7C15 % (1 << 64)
            digits += f"{(value ^ value >> 32) & 15:x}"
        return digits

    def likeness(a, b):
        if not a or not b:
            return float(a == b)
        agree = sum(x == y for x, y in zip(a, b)) / 256
        return min(1.0, max(0.0, (agree - 1 / 16) / (15 / 16)))

    texts = {}
    for r in made:
        texts.setdefault(r[0], []).append(r[1] or "")
    assert len(found) == len(made)
    for r in found:
        assert r["fingerprint"] in {plain(t) for t in texts[r["doc_id"]]}
        assert r["near_edited"] == pytest.approx(likeness(r["fingerprint"], r["edited_fingerprint"]))
        if len(r["fingerprint"]) and r["near_next"] == 1:
            assert r["fingerprint"] in {plain(t) for some in texts.values() for t in some}


def test_records_are_read_by_as_many_tasks_as_their_bytes_ask_for(spark, monkeypatch):
    monkeypatch.setattr(warc, "READ_BYTES", 2000)
    monkeypatch.setattr(warc, "STRETCH_BYTES", 500)
    rng = random.Random(3)
    pages = spark.createDataFrame(
        [(i, f"http://h{i % 9}.org/{i}", f"{rng.random()} " * 30) for i in range(200)],
        "page_id long, url string, html string",
    )
    index = warc.archived(pages)
    found = warc.read_records(index, warc.lookup(index, warc.keys_of(pages)))
    tasks = -(-index.n_bytes // 2000)
    assert tasks > 20
    assert found.rdd.getNumPartitions() == tasks
    assert found.count() == 200
    assert found.select(F.spark_partition_id()).distinct().count() > tasks / 3


def test_overlapping_sources_fill_what_others_cannot(spark):
    docs = spark.createDataFrame(
        [(i, ["a"], 10) for i in range(50)] + [(100 + i, ["a", "b"], 10) for i in range(50)],
        "id long, sources array<string>, size long",
    )
    found = mixing.mix(docs, ["id"], weights=(1, 1), share=Fraction(1, 1), most=2)
    taken = {r["id"]: r["taken"] for r in found.taken.collect()}
    assert sum(taken.values()) == 1500 and max(taken.values()) <= 20
    assert min(v for k, v in taken.items() if k >= 100) >= 10

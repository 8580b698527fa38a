from __future__ import annotations

import hashlib
import zlib

import pytest
from corpus_cases import SCHEMA, multiset, rows, table
from pyspark.sql import functions as F

from pointloom.llm import merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row, text):
    doc_id, _, lang, source, n_chars = row
    values = (doc_id, source, lang, n_chars, text)
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_levels(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 8])) for i in range(0, len(levels[-1]), 8)])
    return levels


def climbed(levels, i, digest):
    """What a digest folds to, and the siblings on its way."""
    siblings = ""
    for level in levels[:-1]:
        first = i // 8 * 8
        run = level[first : first + 8]
        siblings += "".join(run[: i - first] + run[i - first + 1 :])
        digest = sha("".join(run[: i - first] + [digest] + run[i - first + 1 :]))
        i //= 8
    return digest, siblings


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def plain(made):
    trees = {}
    for row in made:
        trees.setdefault(row[2], []).append((row, plain_leaf(row, row[1])))
    order = sorted(trees, key=lambda lang: (lang is not None, (lang or "").encode()))
    for lang in order:
        trees[lang].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
    levels = {lang: plain_levels([leaf for _, leaf in trees[lang]]) for lang in order}
    above = plain_levels([levels[lang][-1][0] for lang in order])
    root, found = above[-1][0], []
    for at, lang in enumerate(order):
        subroot = levels[lang][-1][0]
        for i, (row, leaf) in enumerate(trees[lang]):
            shown = leaf
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[1] is not None:
                shown = plain_leaf(row, lowered(row[1]))
            own, siblings = climbed(levels[lang], i, shown)
            top, more = climbed(above, at, own)
            proof = sha(siblings + more)
            found.append((row[0], leaf, subroot, root, proof, top, top == root))
    return found


def many(n, langs=("en", "de", None, "", "Ö")):
    return [(i, f"Text {i}", langs[i % 7 % len(langs)], "s", i) for i in range(n)]


@pytest.mark.parametrize("made", [rows(), many(1), many(9), many(700), many(4200, ("en",)), [*many(12), *many(12)]])
def test_equals_plain_trees(spark, made):
    found = merkle.audited(table(spark, made)).collect()
    assert multiset(map(tuple, found)) == multiset(plain(made))


def test_no_documents(spark):
    assert merkle.audited(table(spark, [])).collect() == []


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 64, 65, 72, 511, 512, 513, 600, 4097])
def test_positions_are_those_of_an_append_log(n):
    log, open_ = [], [0] * 8
    top = merkle.height(n)

    def close(level):
        log.append((level, open_[level]))
        open_[level] += 1

    for i in range(n):
        close(0)
        for level in range(1, top + 1):
            if (i + 1) % 8**level == 0:
                close(level)
    for level in range(1, top + 1):
        if open_[level] < merkle.nodes_at(n, level):
            close(level)
    assert [merkle.position(n, *node) for node in log] == list(range(len(log)))


def test_log_is_whole_and_in_order_of_completion(spark):
    made = many(1300, ("en", "de"))
    found = merkle.manifest(table(spark, made))
    nodes = [r for tier in found.trees for r in tier.collect()]
    for tree, n in {(r["tree"], r["n"]) for r in nodes}:
        at = sorted(r["position"] for r in nodes if r["tree"] == tree)
        assert at == list(range(len(at)))
        assert len(at) == sum(merkle.nodes_at(n, k) for k in range(merkle.height(n) + 1))
    files = found.trees[0].withColumn("file", F.input_file_name()).withColumn(
        "at", F.monotonically_increasing_id()
    )
    for file in {r["file"] for r in files.select("file").distinct().collect()}:
        written = files.filter(F.col("file") == file).orderBy("at").collect()
        assert all(
            a["position"] < b["position"] for a, b in zip(written, written[1:])
            if a["tree"] == b["tree"] and a["i"] >> 9 - 3 * a["level"] == b["i"] >> 9 - 3 * b["level"]
        )


def test_proofs_have_the_siblings(spark):
    made = many(700, ("en",))
    found = merkle.proofs(merkle.manifest(table(spark, made))).collect()
    assert len(found) == 700
    for row in found:
        path = merkle.decoded(bytes(row["path"]))
        assert merkle.folded(bytes(row["digest"]), path) == bytes(row["root"])


def test_texts_are_not_shuffled(spark):
    plan = merkle.leaves_of(spark.createDataFrame(many(5), SCHEMA))._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Python" not in plan

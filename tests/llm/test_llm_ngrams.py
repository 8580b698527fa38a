from __future__ import annotations

import math
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from corpus_cases import SCHEMA, clean, lower, rows, table

from pointloom.llm import ngrams
from pointloom.llm.catalogue import QUERIES
from pointloom.llm.eliasfano import EliasFano, encode


def kept(p):
    """A probability as it is quantised."""
    return 10 ** (-min(255, round(-math.log10(max(p, 1e-300)) * ngrams.STEPS)) / ngrams.STEPS)


class Plain:
    """The same model with dictionaries."""

    def __init__(self, made, order, least=2):
        self.texts = [(r[0], ["<s>", *clean(lower(r[1] or "")), "</s>"]) for r in made]
        train = [t for i, t in self.texts if self.learned(i)]
        self.words = Counter(w for t in train for w in t[1:])
        self.order, self.n_docs = order, len(train)
        self.n, self.v = sum(self.words.values()), len(self.words)
        self.grams, self.rest = {}, {}
        for k in range(2, order + 1):
            count = Counter(tuple(t[j - k + 1 : j + 1]) for t in train for j in range(k - 1, len(t)))
            ok = {
                g: c for g, c in count.items()
                if c >= least
                and (k == 2 or (g[:-1] in self.grams[k - 1] and g[1:] in self.grams[k - 1]))
            }
            self.grams[k] = ok
            mass = Counter()
            for g, c in ok.items():
                mass[g[:-1]] += c - ngrams.DISCOUNT
            self.rest[k] = {c: 1 - m / self.context(c) for c, m in mass.items()}

    @staticmethod
    def learned(doc_id):
        return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 != 2

    def context(self, c):
        if len(c) > 1:
            return self.grams[len(c)][c]
        return self.n_docs if c == ("<s>",) else self.words[c[0]]

    def score(self, tokens):
        base = total = 0.0
        for j in range(1, len(tokens)):
            p = (self.words[tokens[j]] + 1) / (self.n + self.v + 1)
            base += math.log10(p)
            for k in range(2, min(self.order, j + 1) + 1):
                gram = tuple(tokens[j - k + 1 : j + 1])
                own = 0.0
                if gram in self.grams[k]:
                    share = (self.grams[k][gram] - ngrams.DISCOUNT) / self.context(gram[:-1])
                    own = kept(share)
                p = own + kept(self.rest[k].get(gram[:-1], 1.0)) * p
            total += math.log10(p)
        return base, total


def compare(made, order, result, least=1):
    model = Plain(made, order, least)
    expected = []
    for doc_id, tokens in model.texts:
        base, total = model.score(tokens)
        known = sum(w in model.words for w in tokens[1:])
        expected.append(
            (doc_id, not model.learned(doc_id), len(tokens) - 1, known, model.n,
             round(base, 6), round(total, 6))
        )
    found = [(*r[:5], round(r[5], 6), round(r[6], 6)) for r in result.collect()]
    assert sorted(map(repr, found)) == sorted(map(repr, expected))


@pytest.mark.parametrize(("order", "least"), [(2, 2), (3, 2), (2, 1), (3, 1), (4, 1)])
def test_equals_plain_model_in_many_chunks_and_segments(spark, order, least):
    made = rows()
    docs = table(spark, made)
    model = ngrams.fit(docs, order, least, chunk_tokens=500, segment_rows=37)
    assert all(len(level.segments) > 2 for level in model.levels)
    # One word is on a large share of all places, so its successors are cut.
    assert len(model.levels[1].directory()["split"])
    compare(made, order, ngrams.scored(docs, model), least)


def test_levels_are_compact(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = ngrams.fit(docs)
    for level, most in ((model.levels[1], 8), (model.levels[2], 5)):
        held = sum((Path(level.folder) / name).stat().st_size for name in level.segments)
        assert held / level.size < most
    assert "counts" not in ngrams.Reader(model.levels[2]).segment(0)


def test_nothing_to_learn_from(spark):
    docs = table(spark, [(None, "a b", "en", "s", 3), (None, None, "en", "s", 3)])
    compare([(None, "a b"), (None, None)], 2, ngrams.scored(docs, ngrams.fit(docs)))
    empty = table(spark, [])
    assert ngrams.scored(empty, ngrams.fit(empty)).collect() == []


def test_model_beats_words_alone_on_held_out_text(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = ngrams.scored(docs, ngrams.fit(docs)).filter("held_out")
    row = held_out.selectExpr("sum(score) AS score", "sum(base_score) AS base").first()
    assert row["score"] > row["base"]


def queried(spark, made, folder):
    spark.createDataFrame(made, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    return QUERIES["op4_ngrams"](spark, str(folder))


def test_query_looks_at_more_than_one_word_before(spark, tmp_path):
    learned = [i for i in range(100) if Plain.learned(i)][:40]
    held_out = [i for i in range(100) if not Plain.learned(i)][:2]
    made = [(i, "a x b" if n % 2 else "c x d", "en", "s", 5) for n, i in enumerate(learned)]
    made += [(i, text, "en", "s", 5) for i, text in zip(held_out, ("a x b", "a x d"))]
    score = {r["doc_id"]: r["score"] for r in queried(spark, made, tmp_path).collect()}
    assert score[held_out[0]] > score[held_out[1]] + 0.5


def test_query_keeps_ngrams_seen_once(spark, tmp_path):
    made = rows()
    model = Plain(made, ngrams.ORDER, least=1)
    expected = [(i, round(model.score(tokens)[1], 6)) for i, tokens in model.texts]
    found = queried(spark, made, tmp_path).select("doc_id", "score").collect()
    assert sorted(map(repr, expected)) == sorted(repr((r[0], round(r[1], 6))) for r in found)


@pytest.mark.parametrize("block", [1, 7, 1 << 20])
def test_words_are_told_by_their_hashes(monkeypatch, block):
    monkeypatch.setattr(ngrams, "BLOCK_BYTES", block)
    text = " ".join(r[1] or "" for r in rows()[:10]) + "  a\tb\n\x0bc\x0c\rd\x1ce  ß\x85 " + "long" * 300
    line = text.encode()
    begins, hashes = ngrams.word_hashes(line)
    words = line.split()
    assert [line[b:].split()[0] for b in begins.tolist()] == words
    assert len(set(zip(hashes.tolist(), words))) == len(set(words)) == len(set(hashes.tolist()))


@pytest.mark.parametrize("top", [1, 5, 100, 10**6, 2**40, 2**63, 2**64 - 1])
@pytest.mark.parametrize("n", [0, 1, 2, 70, 3000])
def test_sequence_finds_and_returns_values(top, n):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, top, n, np.uint64, endpoint=True))
    sequence = EliasFano(encode(values))
    assert (sequence.access(np.arange(n)) == values).all()
    asked = np.concatenate((values, rng.integers(0, top, 50, np.uint64, endpoint=True)))
    place, equal = sequence.find(asked)
    assert (place == np.searchsorted(values, asked)).all()
    assert (equal == np.isin(asked, values)).all()


def test_sequence_is_compact():
    values = np.sort(np.random.default_rng(1).integers(0, 1 << 40, 100_000, np.uint64))
    assert sum(a.nbytes for a in encode(values).values()) < 4 * len(values)

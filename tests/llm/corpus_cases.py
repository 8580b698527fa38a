"""Documents with everything that may go wrong, and plain reference code."""

from __future__ import annotations

import random
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def rows(seed: int = 1) -> list[tuple]:
    """Copies, near copies, shared passages, nulls, ties, repeats, one very long text."""
    rng = random.Random(seed)
    passage = prose(rng, 60)
    base = prose(rng, 300)
    near = base.split()
    near[150] = "changed"
    texts = [
        base, base, " ".join(near), f"{prose(rng, 40)} {passage} {prose(rng, 30)}",
        f"{passage}\n{prose(rng, 20)}", prose(rng, 5), prose(rng, 2), "word", "", "   \n\t ", None,
        "loop " * 90, prose(rng, 20_000, 5_000), "Öl ß  x y z a\x1cb", prose(rng, 34),
        prose(rng, 35), prose(rng, 36), "x" * 50_000,
    ]
    texts += [prose(rng, rng.randrange(1, 120)) for _ in range(40)]
    made = [
        (i, t, "en", f"src{i % 3}" if i % 7 else None, len(t or "")) for i, t in enumerate(texts)
    ]
    made += [made[3], made[3], made[10]]  # rows that repeat
    made += [(5, prose(rng, 50), "de", "src1", 1), (5, "", "de", "src1", 0)]  # an id that repeats
    made += [(None, prose(rng, 40), "fr", "src0", 3), (None, None, None, None, None)]
    made += [(None, base, None, "src2", None), (-4, base.upper(), "en", "src2", 7)]
    return made


def table(spark: SparkSession, made: list[tuple] | None = None, parts: int = 5) -> DataFrame:
    """The rows in several partitions, with extra columns named like what operators use."""
    plain = spark.createDataFrame(rows() if made is None else made, SCHEMA).repartition(parts)
    extra = ("TEXT", "Doc_ID", "fp", "h", "key", "file", "row", "sources", "size", "__column_0")
    return plain.select("*", *[F.lit(f"extra {n}").alias(n) for n in extra])


def clean(text: str | None) -> list[str]:
    return WORDS.findall(text or "")


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def multiset(found) -> list:
    return sorted(map(repr, found))

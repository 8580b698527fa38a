"""One query per corpus operator, over its whole table, and SQL where it can tell the rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pointloom.llm import (
    centroids,
    merkle,
    minhash,
    mixing,
    near_copies,
    ngrams,
    pii,
    positional,
    secrets,
    simhash,
    substrings,
    toxicity,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written, indexed, looked up by the keys of all pages, and read back."""
    pages = _table(spark, sf_dir, "pages")
    index = warc.archived(pages)
    return warc.read_records(index, warc.lookup(index, warc.keys_of(pages)))


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.compared_with_next(_table(spark, sf_dir, "documents"))
    prints = ("fingerprint", "edited_fingerprint")
    return found.withColumns({name: F.lower(F.hex(name)) for name in prints})


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.without_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op4_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By all n-grams of the training fold, those seen once included."""
    docs = _table(spark, sf_dir, "documents")
    return ngrams.scored(docs, ngrams.fit(docs, least=1))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scanned(_table(spark, sf_dir, "documents"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return secrets.scanned(docs, secrets.fit(docs))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = positional.build_index(_table(spark, sf_dir, "documents"))
    found = positional.contaminated(index, _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(_table(spark, sf_dir, "documents"))


def op9_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits("fp").alias("fingerprint"), "component_id")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    held_out = (~toxicity.training_fold()).alias("held_out")
    return toxicity.scored(docs, model).select("doc_id", held_out, "score", "predicted")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audited(_table(spark, sf_dir, "documents"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.measured(centroids.clustered(_table(spark, sf_dir, "embeddings")))


def op13_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies.near_copies(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_warc,
        op2_minhash,
        op3_substrings,
        op4_ngrams,
        op5_pii,
        op6_secrets,
        op7_decontamination,
        op8_mixing,
        op9_simhash_trie,
        op10_toxicity,
        op11_merkle,
        op12_centroids,
        op13_near_copies,
    )
}

# Windows are compared as their words, joined.
_FOLDED = r"""regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
_OP7 = f"""
    WITH w AS (SELECT doc_id, row_number() OVER () AS rid, {_FOLDED} AS words FROM documents),
    b AS (SELECT item_id, {_FOLDED} AS words FROM benchmark),
    bw AS (
        SELECT DISTINCT item_id, least(10, len(words)) AS size,
            array_to_string(words[i : i + 9], ' ') AS win
        FROM (SELECT item_id, words,
                unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i FROM b WHERE len(words) > 0)),
    sizes AS (SELECT DISTINCT size FROM bw),
    dw AS (
        SELECT rid, size, i, array_to_string(words[i : i + size - 1], ' ') AS win
        FROM (SELECT rid, size, words, unnest(range(1, len(words) - size + 2)) AS i
              FROM w, sizes WHERE len(words) >= size)),
    m AS (SELECT rid, item_id, i, dw.size FROM dw JOIN bw USING (win, size)),
    h AS (SELECT rid, count(DISTINCT p) AS n_hit
          FROM (SELECT rid, unnest(range(i, i + size)) AS p FROM m) GROUP BY rid),
    t AS (SELECT rid, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS id FROM m) GROUP BY rid)
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
        coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
        coalesce(n_hit, 0) > 0 AS contaminated
    FROM w LEFT JOIN h USING (rid) LEFT JOIN t USING (rid)"""

_OP1 = """
    SELECT page_id, payload_bytes, payload_digest,
        CASE WHEN shared THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN shared THEN leader END AS refers_to
    FROM (SELECT page_id, octet_length(encode(payload)) AS payload_bytes,
            sha1(payload) AS payload_digest, max(page_id) OVER (PARTITION BY payload) AS leader,
            octet_length(encode(payload)) >= 1000
                AND page_id < max(page_id) OVER (PARTITION BY payload) AS shared
          FROM (SELECT page_id, coalesce(html, '') AS payload FROM pages))"""

_OP3 = r"""
    WITH w AS (
        SELECT doc_id, row_number() OVER () AS rid,
            regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
        FROM documents),
    win AS (
        SELECT rid, i, array_to_string(words[i : i + 34], ' ') AS win
        FROM (SELECT rid, words, unnest(range(1, len(words) - 33)) AS i FROM w
              WHERE len(words) >= 35)),
    dup AS (SELECT rid, i FROM win JOIN (SELECT win FROM win GROUP BY win HAVING count(*) > 1)
            USING (win)),
    gone AS (SELECT DISTINCT rid, unnest(range(i, i + 35)) AS p FROM dup),
    kept AS (
        SELECT t.rid, string_agg(word, ' ' ORDER BY t.p) AS text, count(*) AS n
        FROM (SELECT rid, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM w) t
        ANTI JOIN gone ON t.rid = gone.rid AND t.p = gone.p GROUP BY t.rid)
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
        CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
        sha256(coalesce(kept.text, '')) AS kept_sha256
    FROM w LEFT JOIN kept USING (rid)"""

# Trees of up to 8 ** 7 leaves, and 8 ** 4 languages; longer ones only take more levels.
def _merkle_levels(leaves: str, name: str, levels: int) -> str:
    """Tables ``{name}_0`` to ``{name}_{levels}`` (g, i, d, c): nodes and how many a level has."""
    made = [f"{name}_0 AS (SELECT g, i, d, count(*) OVER (PARTITION BY g) AS c FROM {leaves})"]
    for k in range(levels):
        made.append(f"""{name}_{k + 1} AS (
            SELECT g, i, d, count(*) OVER (PARTITION BY g) AS c FROM (
                SELECT g, i // 8 AS i, CASE WHEN any_value(c) = 1 THEN any_value(d)
                    ELSE sha256(string_agg(d, '' ORDER BY i)) END AS d
                FROM {name}_{k} GROUP BY g, i // 8))""")
    return ",\n".join(made)


def _merkle_climb(name: str, levels: int, before: str) -> str:
    """From ``before`` (r, g, i, f, proof): what the digests f fold to, and siblings added."""
    made = []
    for k in range(levels):
        made.append(f"""{name}_up_{k} AS (
            SELECT r, any_value(b.g) AS g, any_value(b.i) // 8 AS i,
                CASE WHEN any_value(c) = 1 THEN any_value(f) ELSE
                    sha256(string_agg(CASE WHEN n.i = b.i THEN f ELSE d END, '' ORDER BY n.i)) END AS f,
                any_value(proof)
                    || coalesce(string_agg(d, '' ORDER BY n.i) FILTER (n.i <> b.i), '') AS proof
            FROM {before} b JOIN {name}_{k} n ON n.g = b.g AND n.i // 8 = b.i // 8 GROUP BY r)""")
        before = f"{name}_up_{k}"
    return ",\n".join(made)


def _piece(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"coalesce(octet_length(encode({text})) || ':' || {text}, '-')"


_LEAF = " || ".join(_piece(c) for c in ("doc_id", "source", "lang", "n_chars"))
_FOLDED_TEXT = (
    "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)
# Eight steps of the polynomial for each byte of the id.
_CRC_STEP = "CASE WHEN {x} & 1 = 1 THEN xor({x} >> 1, 3988292384) ELSE {x} >> 1 END"
_OP11 = f"""
    WITH RECURSIVE crc AS (
        SELECT doc_id, CAST(doc_id AS VARCHAR) AS s, CAST(0 AS BIGINT) AS k, CAST(4294967295 AS BIGINT) AS x
        FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)
        UNION ALL
        SELECT doc_id, s, k + 1, {_CRC_STEP.format(x="y")}
        FROM (SELECT *, CASE WHEN k % 8 = 0
                THEN xor(x, CAST(ascii(substr(s, CAST(k // 8 + 1 AS INT), 1)) AS BIGINT)) ELSE x END AS y
              FROM crc WHERE k < 8 * length(s))),
    hit AS (SELECT doc_id, xor(x, 4294967295) % 3 = 0 AS hit FROM crc WHERE k = 8 * length(s)),
    docs AS (
        SELECT row_number() OVER () AS r, doc_id, coalesce('=' || lang, '') AS g,
            sha256({_LEAF} || {_piece("text")}) AS d,
            CASE WHEN hit THEN sha256({_LEAF} || {_piece(_FOLDED_TEXT)}) END AS shown
        FROM documents LEFT JOIN hit USING (doc_id)),
    leaf AS (
        SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, d) - 1 AS i FROM docs),
    {_merkle_levels("leaf", "t", 7)},
    sub AS (SELECT g AS lang, '' AS g, row_number() OVER (ORDER BY g) - 1 AS i, d FROM t_7),
    {_merkle_levels("sub", "u", 4)},
    begun AS (SELECT r, g, i, coalesce(shown, d) AS f, '' AS proof FROM leaf),
    {_merkle_climb("t", 7, "begun")},
    between AS (
        SELECT r, '' AS g, sub.i AS i, f, proof FROM t_up_6 JOIN sub ON sub.lang = t_up_6.g),
    {_merkle_climb("u", 4, "between")}
    SELECT doc_id, leaf.d AS leaf, sub.d AS subroot, u_4.d AS root, sha256(proof) AS proof_sha256,
        f AS folded_root, f = u_4.d AS verified
    FROM leaf JOIN sub ON sub.lang = leaf.g JOIN u_up_3 USING (r), u_4"""


def _clusters(k: int) -> str:
    """Assign every vector to the nearest centroid of ``c{k}``."""
    return f"""a{k} AS (
        SELECT r, any_value(e.vec_id) AS vec_id, any_value(e.v) AS v, min(struct_pack(
            d := list_sum(list_transform(list_zip(e.v, c{k}.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))),
            c := c{k}.c)) AS best
        FROM e, c{k} GROUP BY r)"""


def _means(k: int) -> str:
    """Move each centroid to the floor of its vectors' mean; empty ones stay."""
    return f"""c{k + 1} AS (
        SELECT c, coalesce(m.v, c{k}.v) AS v FROM c{k} LEFT JOIN (
            SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY j) AS v FROM (
                SELECT best.c AS c, j, CAST(sum(v[j]) AS BIGINT) AS s, count(*) AS n
                FROM a{k}, (SELECT unnest(range(1, 65)) AS j) GROUP BY best.c, j)
            GROUP BY c) m USING (c))"""


_OP12 = f"""
    WITH e AS (
        SELECT row_number() OVER () AS r, vec_id,
            list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings
        WHERE len(embedding) = 64
            AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(CAST(x AS DOUBLE)))) = 64),
    c0 AS (
        SELECT row_number() OVER (ORDER BY key, v) - 1 AS c, v
        FROM (SELECT v, sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS key FROM e
              ORDER BY key, v LIMIT 16)),
    {", ".join(f"{_clusters(k)}, {_means(k)}" for k in range(3))},
    {_clusters(3)}
    SELECT vec_id, CAST(best.c AS INTEGER) AS cluster, CAST(best.d AS BIGINT) AS distance,
        CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia,
        CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
        sha256(array_to_string(c3.v, ',')) AS centroid_sha256
    FROM a3 JOIN c3 ON c3.c = a3.best.c"""

_OP13 = r"""
    WITH RECURSIVE w AS (
        SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x20\x09-\x0D]+') AS words
        FROM documents),
    d AS (
        SELECT r, doc_id, CASE WHEN len(words) < 2 THEN words ELSE list_distinct(list_transform(
            range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) END AS found
        FROM w),
    s AS (SELECT r, unnest(found) AS shingle FROM d),
    size AS (SELECT r, len(found) AS n FROM d),
    pairs AS (SELECT a.r AS a, b.r AS b, count(*) AS n_both FROM s a JOIN s b USING (shingle)
              WHERE a.r <> b.r GROUP BY a.r, b.r),
    link AS (SELECT a, b FROM pairs JOIN size x ON x.r = a JOIN size y ON y.r = b
             WHERE 100 * n_both >= 80 * (x.n + y.n - n_both)),
    reach AS (SELECT r, r AS to_ FROM d UNION SELECT reach.r, link.b FROM reach JOIN link ON link.a = to_),
    least AS (SELECT reach.r, min(d.doc_id) AS component_id
              FROM reach JOIN d ON d.r = reach.to_ GROUP BY reach.r)
    SELECT doc_id, CAST(len(found) AS BIGINT) AS n_shingles, component_id,
        doc_id IS NOT DISTINCT FROM component_id AS kept
    FROM d JOIN least USING (r)"""

ORACLES: dict[str, str] = {
    "op3_substrings": _OP3,
    "op1_warc": _OP1,
    "op7_decontamination": _OP7,
    "op11_merkle": _OP11,
    "op12_centroids": _OP12,
    "op13_near_copies": _OP13,
}

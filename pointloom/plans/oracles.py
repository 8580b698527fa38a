"""SQL with the expected rows of each query in the catalogue."""

from __future__ import annotations

from pointloom.plans.inputs import (
    BLOBS,
    CHANGES,
    DIRTY,
    GEO,
    PTS,
    REFERENCE,
    RINGS,
    START,
    with_magnitudes,
)

MAGNITUDE = "sqrt(x * x + y * y + z * z)"

# The sorted fitted centers of the blobs are those of groups 2, 0 and 1.
BLOB_CLUSTER = "CAST(CASE c_custkey % 3 WHEN 2 THEN 0 WHEN 0 THEN 1 ELSE 2 END AS INTEGER)"
RING_CLUSTER = "CAST(c_custkey % 3 AS INTEGER)"


def _distance_km(lat: str = "lat", lon: str = "lon") -> str:
    ref_lat, ref_lon = (f"radians(CAST({v} AS DOUBLE))" for v in REFERENCE)
    return (
        f"2 * 6371 * asin(least(1, sqrt(pow(sin(({ref_lat} - radians({lat})) / 2), 2) "
        f"+ cos(radians({lat})) * cos({ref_lat}) "
        f"* pow(sin(({ref_lon} - radians({lon})) / 2), 2))))"
    )


def _double(value: float) -> str:
    return f"CAST({value} AS DOUBLE)"


def _nearest_start() -> str:
    d = [
        " + ".join(f"({c} - {_double(v)}) * ({c} - {_double(v)})" for c, v in zip("xyz", center))
        for center in START
    ]
    return (
        f"CASE WHEN {d[0]} <= {d[1]} AND {d[0]} <= {d[2]} THEN 0 "
        f"WHEN {d[1]} <= {d[2]} THEN 1 ELSE 2 END"
    )


def _silhouette(rows: str, columns: list[str]) -> str:
    """``rows`` selects the columns and an integer ``g``; sums of squares, no means."""
    square = " + ".join(f"{c} * {c}" for c in columns)
    sums = ", ".join(f"sum({c}) AS s_{c}" for c in columns)
    dot = " + ".join(f"p.{c} * s.s_{c}" for c in columns)
    return f"""
        WITH p AS (SELECT *, {square} AS q, row_number() OVER () AS id FROM ({rows})),
        s AS (SELECT g, count(*) AS n, sum(q) AS sq, {sums} FROM p GROUP BY g),
        d AS (SELECT p.id, p.g = s.g AS own, s.n AS n,
                CASE WHEN p.g = s.g THEN (s.n * p.q + s.sq - 2 * ({dot})) / (s.n - 1)
                     ELSE p.q + s.sq / s.n - 2 * ({dot}) / s.n END AS dist
              FROM p, s),
        ab AS (SELECT id, max(dist) FILTER (own) AS a, min(dist) FILTER (NOT own) AS b
               FROM d GROUP BY id)
        SELECT round(avg(CASE WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0 END), 6)
               AS silhouette_score
        FROM ab"""


def _updates(points: str, columns: str, start: list[tuple[float, ...]], steps: int) -> list[str]:
    """Tables ``pts`` (with ``pid``), ``c0`` to ``c<steps>`` (centers) and for each of them but the
    last ``a<i>``, the nearest center of every point, lowest number first."""
    first = " UNION ALL ".join(
        f"SELECT {i} AS cluster, CAST(0 AS BIGINT) AS n, "
        + ", ".join(f"{_double(v)} AS {c}" for c, v in zip(columns, center))
        for i, center in enumerate(start)
    )
    tables = [f"pts AS (SELECT *, row_number() OVER () AS pid FROM ({points}))", f"c0 AS ({first})"]
    means = ", ".join(f"avg({c}) AS {c}" for c in columns)
    for i in range(1, steps + 1):
        tables += [
            _nearest(columns, i - 1),
            f"c{i} AS (SELECT cluster, count(*) AS n, {means} FROM a{i - 1} GROUP BY cluster)",
        ]
    return tables


def _nearest(columns: str, i: int) -> str:
    distance = " + ".join(f"(p.{c} - c.{c}) * (p.{c} - c.{c})" for c in columns)
    values = ", ".join(f"any_value({c}) AS {c}" for c in columns)
    own = ", ".join(f"p.{c}" for c in columns)
    return (
        f"a{i} AS (SELECT pid, arg_min(cluster, (dist, cluster)) AS cluster, {values} "
        f"FROM (SELECT p.pid, {own}, c.cluster, {distance} AS dist FROM pts p, c{i} c) GROUP BY pid)"
    )


def _lloyd(steps: int) -> str:
    return (
        f"WITH {', '.join(_updates(PTS, 'xyz', START, steps))} "
        f"SELECT CAST(cluster AS INTEGER) AS cluster, n, "
        f"round(x, 6) AS x, round(y, 6) AS y, round(z, 6) AS z FROM c{steps}"
    )


def _whole_job(steps: int) -> str:
    """Labels of the last centers, what they hold together, and their score."""
    points = f"SELECT x, y, z, {MAGNITUDE} AS m FROM ({PTS})"
    tables = [*_updates(points, "xyzm", with_magnitudes(START), steps), _nearest("xyzm", steps)]
    labelled = f"(SELECT x, y, z, m, cluster AS g FROM a{steps})"
    score = _silhouette(f"SELECT * FROM {labelled}", ["x", "y", "z", "m"])
    return (
        f"WITH {', '.join(tables)} SELECT CAST(g AS INTEGER) AS cluster, count(*) AS n_rows, "
        "round(avg(x), 6) AS x, round(avg(y), 6) AS y, round(avg(z), 6) AS z, "
        f"round(avg(m), 6) AS magnitude, (SELECT silhouette_score FROM ({score})) AS silhouette_score "
        f"FROM {labelled} GROUP BY g"
    )


def _feature_means() -> str:
    cloud = f"FROM ({BLOBS})"
    geo = f"FROM ({GEO})"
    km = _distance_km()
    x, y, z = ("x", "x"), ("y", "y"), ("z", "z")
    length = ("magnitude", MAGNITUDE)
    tables = [
        ("cloud", "cloud", [x, y, z, length], cloud),
        ("cloud+intensity", "cloud", [x, y, z, length, ("intensity", "z / 10")], cloud),
        ("geo", "geo", [("distance_to_center_km", km)], geo),
        ("geo+elevation", "geo",
         [("distance_to_center_km", km), ("elevation", "c_custkey % 13")], geo),
        ("cloud+geo", "cloud", [x, y, z, length], cloud),
        ("upper case", "numeric", [("X", "x"), ("Y", "y"), ("Z", "z")], cloud),
        ("numeric", "numeric", [("c_acctbal", "c_acctbal")], "FROM customer"),
        ("mixed", "numeric",
         [("size", "(p_partkey % 3) * 10000 + p_size"), ("price", "p_retailprice")], "FROM part"),
    ]
    return " UNION ALL ".join(
        f"SELECT '{source}' AS source, '{kind}' AS kind, count(*) AS n_rows, "
        f"CAST({i} AS INTEGER) AS position, '{name}' AS feature, round(avg({value}), 6) AS mean {rows}"
        for source, kind, features, rows in tables
        for i, (name, value) in enumerate(features)
    )


def _uploads() -> str:
    good = " UNION ALL ".join(
        f"SELECT '{name}' AS source, {key} % 3 AS planted, 'Completed' AS status, true AS scored, "
        f"count(*) AS n_uploaded, count(*) AS n_labelled, CAST(1 AS BIGINT) AS labels_per_group, "
        f"true AS groups_apart FROM {table} GROUP BY {key} % 3"
        for name, table, key in (
            ("customer", "customer", "c_custkey"), ("supplier", "supplier", "s_suppkey"),
            ("part", "part", "p_partkey"), ("nation again", "nation", "n_nationkey"),
        )
    )
    return (
        f"SELECT source, CAST(planted AS BIGINT) AS planted, status, scored, n_uploaded, "
        f"n_labelled, labels_per_group, groups_apart FROM ({good}) UNION ALL "
        "SELECT 'nation', CAST(n_nationkey % 3 AS BIGINT), 'Failed', false, count(*), "
        "CAST(0 AS BIGINT), CAST(0 AS BIGINT), false FROM nation GROUP BY n_nationkey % 3"
    )


def _fold(where: str = "") -> str:
    return f"""
        SELECT job_id,
               arg_max(status, (ts, seq)) AS status,
               arg_max(result_path, (ts, seq)) FILTER (result_path IS NOT NULL) AS result_path,
               arg_max(silhouette_score, (ts, seq))
                   FILTER (silhouette_score IS NOT NULL) AS silhouette_score,
               arg_max(error, (ts, seq)) FILTER (error IS NOT NULL) AS error,
               min(ts) AS created_at
        FROM ({CHANGES}) {where} GROUP BY job_id"""


_CLOUD_RESULT = (
    f"SELECT c_custkey, x, y, z, round({MAGNITUDE}, 6) AS magnitude, "
    f"{BLOB_CLUSTER} AS cluster FROM ({BLOBS})"
)
_COMPLETE = "x IS NOT NULL AND NOT isnan(x) AND note IS NOT NULL"
_RING_RESULT = (
    f"SELECT c_custkey, round({_distance_km()}, 6) AS distance_to_center_km, "
    f"{RING_CLUSTER} AS cluster FROM ({RINGS})"
)
_PLANTED_SCORE = _silhouette(
    f"SELECT x, y, z, {MAGNITUDE} AS m, c_custkey % 3 AS g FROM ({BLOBS})", ["x", "y", "z", "m"]
)

ORACLES: dict[str, str] = {
    "csv_scan": (
        "SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, "
        "CAST(c_nationkey AS INTEGER) AS c_nationkey, c_acctbal, c_mktsegment FROM customer"
    ),
    "results_roundtrip": _CLOUD_RESULT,
    "metrics_roundtrip": _PLANTED_SCORE,
    "preview_top5": f"{PTS} ORDER BY l_orderkey, l_linenumber, x, y, z LIMIT 5",
    "drop_incomplete": f"SELECT * FROM ({DIRTY}) WHERE {_COMPLETE}",
    "feature_set": _feature_means(),
    "magnitude": (
        f"SELECT l_orderkey, l_linenumber, x, y, z, round({MAGNITUDE}, 6) AS magnitude "
        f"FROM ({PTS})"
    ),
    "haversine_km": (
        f"SELECT c_custkey, lat, lon, round({_distance_km()}, 6) AS distance_to_center_km "
        f"FROM ({GEO})"
    ),
    "numeric_fallback": "SELECT p_size, p_retailprice FROM part",
    "vector_assembly": " UNION ALL ".join(
        f"SELECT l_orderkey, l_linenumber, {i} AS position, round({value}, 6) AS value FROM ({PTS})"
        for i, value in enumerate(["x", "y", "z", MAGNITUDE])
    ),
    "assign_nearest": (
        "SELECT l_orderkey, l_linenumber, x, y, z, "
        f"CAST({_nearest_start()} AS INTEGER) AS cluster FROM ({PTS})"
    ),
    "kmeans_cloud": f"SELECT c_custkey, {BLOB_CLUSTER} AS cluster FROM customer",
    "kmeans_geo": _RING_RESULT,
    "kmeans_lloyd": _lloyd(3),
    "silhouette": _PLANTED_SCORE,
    "silhouette_lineitem": _silhouette(
        f"SELECT x, y, z, {_nearest_start()} AS g FROM ({PTS})", ["x", "y", "z"]
    ),
    "silhouette_undefined": (
        "SELECT count(*) AS n_rows, CAST(1 AS BIGINT) AS n_clusters, false AS has_score FROM customer"
    ),
    "cluster_job": (
        f"SELECT c_custkey, x, y, z, note, round({MAGNITUDE}, 6) AS magnitude, "
        f"{BLOB_CLUSTER} AS cluster FROM ({DIRTY}) WHERE {_COMPLETE}"
    ),
    "cluster_job_geo": _RING_RESULT,
    "cluster_job_numeric": (
        "SELECT p_partkey, p_name, CAST((p_partkey % 3) * 10000 + p_size AS INTEGER) AS size, "
        "p_retailprice AS price, CAST(p_partkey % 3 AS INTEGER) AS cluster FROM part"
    ),
    "cluster_lineitem": _whole_job(20),
    "ledger_current": _fold(),
    "ledger_lookup": _fold("WHERE job_id = '7'"),
    "ledger_list": (
        "SELECT replace(name, 'job-', '') AS job_id, name, state, provisioning_state, created "
        "FROM (SELECT CASE event_type WHEN 'view' THEN 'web-' || event_id "
        "WHEN 'click' THEN 'job-retry-job-' || event_id ELSE 'job-' || event_id END AS name, "
        "event_type AS state, CASE event_type WHEN 'error' THEN 'Failed' ELSE 'Succeeded' END "
        "AS provisioning_state, ts AS created FROM events) WHERE starts_with(name, 'job-')"
    ),
    "ledger_list_recorded": (
        "SELECT job_id, 'job-' || job_id AS name, state, CASE state WHEN 'Failed' THEN 'Failed' "
        "WHEN 'Completed' THEN 'Succeeded' ELSE 'Creating' END AS provisioning_state, "
        "created_at AS created FROM (SELECT job_id, CASE status WHEN 'click' THEN 'Running' "
        "WHEN 'purchase' THEN 'Completed' WHEN 'error' THEN 'Failed' ELSE 'Queued' END AS state, "
        f"created_at FROM ({_fold()}))"
    ),
    "upload_stream": _uploads(),
}

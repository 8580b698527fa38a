"""Column expressions over coordinates. All stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean earth radius used for distances.
EARTH_RADIUS_KM = 6371.0


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    """A top-level column by its exact name, dots and backticks included."""
    return F.col(quoted(name))


def _double(name: str) -> Column:
    return column(name).cast("double")


def magnitude(x: str = "x", y: str = "y", z: str = "z") -> Column:
    """Length of the vector (x, y, z)."""
    return F.sqrt(reduce(add, [_double(c) * _double(c) for c in (x, y, z)]))


def haversine_km(lat: str, lon: str, ref_lat: float, ref_lon: float) -> Column:
    """Great-circle distance in km from (lat, lon) degrees to a fixed point.

    The reference point enters as literals, so its radians and cosine are folded
    once at planning time. Rounding can push the root past 1 for antipodes; the
    cap keeps asin defined there. NaN gives NaN, and so does an infinite coordinate.
    """
    phi, lam = F.radians(_double(lat)), F.radians(_double(lon))
    phi0, lam0 = F.radians(F.lit(float(ref_lat))), F.radians(F.lit(float(ref_lon)))
    half_lat = F.sin((phi0 - phi) / 2)
    half_lon = F.sin((lam0 - lam) / 2)
    chord = half_lat * half_lat + F.cos(phi) * F.cos(phi0) * half_lon * half_lon
    # NaN counts as larger than any number, and has to stay what it is.
    capped = F.when((chord > 1) & ~F.isnan(chord), F.lit(1.0)).otherwise(chord)
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(capped))


def squared_distance(names: Sequence[str], center: Sequence[float]) -> Column:
    """Squared Euclidean distance of the named columns to a fixed center.

    One SQL text per center: built operator by operator, the expression would take
    longer to put together than a small table takes to scan.
    """
    gaps = [
        f"(CAST({quoted(n)} AS DOUBLE) - CAST('{float(c)!r}' AS DOUBLE))"
        for n, c in zip(names, center, strict=True)
    ]
    return F.expr(" + ".join(f"{g} * {g}" for g in gaps))

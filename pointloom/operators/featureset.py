"""Which columns describe a point, decided from names and types at planning time."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, NumericType

from pointloom.functions import haversine_km, magnitude

# Column names that decide the branch, derived columns, and the
# types taken when no branch matches.
CLOUD = ("x", "y", "z")
CLOUD_EXTRA = "intensity"
CLOUD_DERIVED = "magnitude"
GEO = ("lat", "lon")
GEO_EXTRA = "elevation"
GEO_DERIVED = "distance_to_center_km"
FALLBACK_TYPES = ("int", "double", "float")


@dataclass(frozen=True)
class FeatureSet:
    """``kind`` is cloud, geo or numeric; ``columns`` are the features in order."""

    kind: str
    columns: tuple[str, ...]

    @property
    def stored(self) -> tuple[str, ...]:
        """The features worth keeping between passes: the magnitude is not, it costs
        less to compute again than to hold."""
        return tuple(c for c in self.columns if (self.kind, c) != ("cloud", CLOUD_DERIVED))

    def complete(self, points: DataFrame) -> DataFrame:
        """All features again from the stored ones."""
        return add_features(points, self) if self.kind == "cloud" else points


def choose_features(
    df: DataFrame, fallback_types: Sequence[str] = FALLBACK_TYPES
) -> FeatureSet:
    """Pick the features of a table; a point cloud wins over geographic points.

    Names are compared exactly, so ``X,Y,Z`` is no point cloud. Derived columns are
    part of the answer although they are only added by :func:`add_features`.
    """
    names = df.columns
    if all(c in names for c in CLOUD):
        extra = (CLOUD_EXTRA,) if CLOUD_EXTRA in names else ()
        _require_numbers(df, CLOUD, extra)
        return FeatureSet("cloud", (*CLOUD, CLOUD_DERIVED, *extra))
    if all(c in names for c in GEO):
        extra = (GEO_EXTRA,) if GEO_EXTRA in names else ()
        _require_numbers(df, GEO, extra)
        return FeatureSet("geo", (GEO_DERIVED, *extra))
    numeric = tuple(name for name, kind in df.dtypes if kind in fallback_types)
    if not numeric:
        raise ValueError(f"no feature columns: none of {names} is {', '.join(fallback_types)}")
    return FeatureSet("numeric", numeric)


def add_features(
    df: DataFrame,
    features: FeatureSet,
    reference: tuple[float, float] = (0.0, 0.0),
) -> DataFrame:
    """Append the derived column of the branch; an input column of that name is replaced."""
    if features.kind == "cloud":
        return df.withColumn(CLOUD_DERIVED, magnitude(*CLOUD))
    if features.kind == "geo":
        return df.withColumn(GEO_DERIVED, haversine_km(*GEO, *reference))
    return df


def _require_numbers(df: DataFrame, coordinates: Sequence[str], extra: Sequence[str]) -> None:
    kinds = {f.name: f.dataType for f in df.schema.fields}
    bad = [c for c in coordinates if not isinstance(kinds[c], NumericType)]
    bad += [c for c in extra if not isinstance(kinds[c], (NumericType, BooleanType))]
    if bad:
        found = ", ".join(f"{c} ({kinds[c].simpleString()})" for c in bad)
        raise ValueError(f"columns must be numeric: {found}")

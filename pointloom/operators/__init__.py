from pointloom.operators.cleaning import drop_incomplete
from pointloom.operators.featureset import FeatureSet, add_features, choose_features
from pointloom.operators.kmeans import (
    assemble,
    assign_nearest,
    canonical_ids,
    cluster_points,
    fit_kmeans,
    lloyd_steps,
    staged,
    update_centers,
)
from pointloom.operators.silhouette import silhouette

__all__ = [
    "FeatureSet",
    "add_features",
    "assemble",
    "assign_nearest",
    "canonical_ids",
    "choose_features",
    "cluster_points",
    "drop_incomplete",
    "fit_kmeans",
    "lloyd_steps",
    "silhouette",
    "staged",
    "update_centers",
]

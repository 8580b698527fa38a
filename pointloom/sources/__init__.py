from pointloom.sources.points import read_points
from pointloom.sources.results import (
    preview,
    read_metrics,
    write_metrics,
    write_results,
)

__all__ = ["preview", "read_metrics", "read_points", "write_metrics", "write_results"]

"""Point clustering on Spark: scan, clean, derive features, cluster, score, write."""

__all__ = ["JobResult", "run_job"]


def __getattr__(name: str):
    """The job is imported when it is asked for: tasks that need other modules of the package
    do without MLlib and its memory."""
    if name not in __all__:
        raise AttributeError(f"module {__name__!r} has no attribute {name!r}")
    from pointloom.plans import cluster_job

    return getattr(cluster_job, name)

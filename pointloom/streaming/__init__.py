from pointloom.streaming.intake import intake
from pointloom.streaming.ledger import (
    Change,
    append_changes,
    compact_ledger,
    current_jobs,
    find_job,
    list_jobs,
    read_ledger,
    recorded_runs,
)

__all__ = [
    "Change",
    "append_changes",
    "compact_ledger",
    "current_jobs",
    "find_job",
    "intake",
    "list_jobs",
    "read_ledger",
    "recorded_runs",
]

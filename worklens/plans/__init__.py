"""The five reports. Each takes input DataFrames and returns the result DataFrame."""

from .classifications import classification_extract
from .issues import issue_daily
from .objects import time_per_object
from .stages import stage_history
from .tasks import task_rollup

__all__ = [
    "classification_extract",
    "issue_daily",
    "stage_history",
    "task_rollup",
    "time_per_object",
]

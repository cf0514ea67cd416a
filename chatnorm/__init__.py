"""chatnorm: turn many differently shaped text datasets into one conversation table on Spark."""

from .types import Mapping, TASK_TYPES

__all__ = ["Mapping", "TASK_TYPES"]

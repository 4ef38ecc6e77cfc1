"""Incremental table maintenance and reconciliation as Spark DataFrame operators."""

from .config import SyncType, TaskConfig

__all__ = ["SyncType", "TaskConfig"]

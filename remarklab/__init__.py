"""Comment-text analytics on Spark DataFrames."""

from .config import DEFAULTS, Settings
from .session import cache_stage, checkpoint_dir, get_session

__all__ = ["DEFAULTS", "Settings", "cache_stage", "checkpoint_dir", "get_session"]

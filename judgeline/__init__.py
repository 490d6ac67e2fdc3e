"""judgeline: ranked retrieval and ranking evaluation as Spark DataFrame jobs."""
from .config import EvalConfig

__all__ = ["EvalConfig"]

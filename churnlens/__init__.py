"""churnlens: churn analytics over clickstream events, built on Spark DataFrames, Spark ML
and Structured Streaming."""

from .config import DEFAULT, Tuning
from .session import ensure_checkpoint_dir, local_session

__all__ = ["DEFAULT", "Tuning", "ensure_checkpoint_dir", "local_session"]
__version__ = "0.1.0"

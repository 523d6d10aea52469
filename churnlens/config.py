"""Knobs that decide physical strategy at scale.

Defaults are sized for a large cluster; tests shrink them to force the
non-broadcast paths on small data.
"""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Tuning:
    # A per-key side table (e.g. one mean per user) is broadcast only when its
    # row count, measured as it is written, is at most this many rows
    # and its measured size at most this many bytes.
    broadcast_max_rows: int = 2_000_000
    broadcast_max_bytes: int = 128 << 20
    # Rows one task sorts comfortably (about a 128 MB input split). A group no
    # larger than this may go to one task.
    task_rows: int = 4_000_000
    # Keys of a stream's state that one partition of it holds comfortably. The
    # number of state partitions is fixed by a checkpoint's first run; each has
    # its own files in every batch.
    state_rows: int = 1_000_000
    # Number of hash buckets for sampling, splitting and folds (integers, so
    # Spark and SQL engines agree exactly).
    buckets: int = 10_000

    def with_(self, **kw) -> "Tuning":
        return replace(self, **kw)


DEFAULT = Tuning()

# Salts keep the three uses of the hash bucket independent: one shared bucket
# would put every down-sampled row into train.
SAMPLE_SALT = "sample"
SPLIT_SALT = "split"
FOLD_SALT = "fold"
PEEK_SALT = "peek"

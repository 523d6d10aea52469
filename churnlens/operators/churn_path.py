"""Action rates on a user's way to churn, by days and by songs played.

Every user has a song clock: the songs played so far. An event is placed by
how many days and how many hundred songs it lies before the user's first
downgrade, first cancellation or, for a user with neither, last event.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Tuning
from ..schema import CLASS_CANCEL, CLASS_DOWNGRADE, CLASS_OTHER, LABEL
from .checkpoint import materialize
from .joins import attach_by_key
from .sequence import running_count_within
from .users import SONG_PAGE

DAY_MS = 86_400_000
#: What orders a user's events; rows that agree in all three happen at once.
ORDER = ["ts", "sessionId", "itemInSession"]


def with_song_clock(events: DataFrame, tuning: Tuning = DEFAULT, method: str = "auto") -> DataFrame:
    """Add ``songs``: the songs the user has played up to and with the event. A hot user is split over tasks."""
    return running_count_within(events, ["userId"], ORDER, F.col("page") == SONG_PAGE, "songs", tuning, method)


def anchors(clocked: DataFrame) -> DataFrame:
    """Per user: rows ``n``, and the first event of each churn class or, without any, the last event of all.

    Columns ``at<class>``, a struct of ``ORDER`` and ``songs``, null where the user has none.
    """
    at = F.struct(*ORDER, "songs")
    churned = F.max(F.col(LABEL).isin(CLASS_DOWNGRADE, CLASS_CANCEL))
    return clocked.where(F.col("userId").isNotNull()).groupBy("userId").agg(
        F.count(F.lit(1)).alias("n"),
        F.when(~churned, F.max(at)).alias(f"at{CLASS_OTHER}"),
        *[F.min(F.when(F.col(LABEL) == k, at)).alias(f"at{k}") for k in (CLASS_DOWNGRADE, CLASS_CANCEL)])


def path_counts(events: DataFrame, songs_per_cell: int = 100, last_cell: int = 1000, tuning: Tuning = DEFAULT,
                method: str = "auto") -> DataFrame:
    """Events per ``(userId, churn, day_cell, song_cell, page)`` strictly before each anchor of the user.

    ``events`` needs userId, page, churn and ``ORDER``; rows without a user are
    left out. The anchors are one row per user, joined by measured size; a
    user with much of the data is salted, and the counts are combined in the
    tasks before the shuffle. Cell ``last_cell`` takes all that is earlier, so
    the longest history does not decide the number of cells.
    """
    kept = events.where(F.col("userId").isNotNull()).select("userId", "page", LABEL, *ORDER)
    clocked = materialize(with_song_clock(kept, tuning, method).select("userId", "page", LABEL, *ORDER, "songs"), "song-clock")
    joined = attach_by_key(clocked.drop(LABEL), anchors(clocked), "userId", "n", tuning, "anchors")
    here = F.struct(*ORDER)

    def cell(before, width):
        return F.least(F.floor(before / F.lit(width)).cast("long"), F.lit(last_cell).cast("long"))
    ways = []
    for k in (CLASS_OTHER, CLASS_DOWNGRADE, CLASS_CANCEL):
        a = F.col(f"at{k}")
        before = here < F.struct(*[a[c].alias(c) for c in ORDER])
        ways.append(F.when(a.isNotNull() & before, F.struct(
            F.lit(k).alias(LABEL),
            cell(a["ts"] - F.col("ts"), DAY_MS).alias("day_cell"),
            cell(a["songs"] - F.col("songs"), songs_per_cell).alias("song_cell"))))
    placed = joined.select("userId", "page", F.explode(F.array_compact(F.array(*ways))).alias("w"))
    return placed.groupBy("userId", f"w.{LABEL}", "w.day_cell", "w.song_cell", "page").agg(F.count(F.lit(1)).alias("n"))


def churn_path(events: DataFrame, songs_per_cell: int = 100, last_cell: int = 1000, tuning: Tuning = DEFAULT,
               method: str = "auto") -> DataFrame:
    """Per churn class, axis (``days``, ``songs``), cell before the anchor and page, events and rates.

    ``n_users`` are the users whose history reaches the cell, ``n_songs`` the
    songs played in it; ``per_user`` and ``per_hundred_songs`` divide the events by
    them (null without songs). The last cell holds all that is earlier. Class 0 are the users who stayed, up to their last event.
    """
    counts = materialize(path_counts(events, songs_per_cell, last_cell, tuning, method), "path-counts")
    axes = {"days": "day_cell", "songs": "song_cell"}
    reach = counts.groupBy("userId", LABEL).agg(*[F.max(c).alias(a) for a, c in axes.items()])
    reach = reach.unpivot(LABEL, list(axes), "axis", "last").groupBy(LABEL, "axis", "last").agg(
        F.count(F.lit(1)).alias("u"))
    by_cell = F.inline(F.array(*[F.struct(F.lit(a).alias("axis"), F.col(c).alias("cell")) for a, c in axes.items()]))
    cells = (counts.select(LABEL, "page", "n", by_cell).groupBy(LABEL, "axis", "cell", "page")
             .agg(F.sum("n").alias("n_events")))
    # From here on rows are cells (at most ``last_cell`` + 1 an axis) and pages, not users. Users reach a cell if their last one is that or later.
    songs = F.sum(F.when(F.col("page") == SONG_PAGE, F.col("n_events")).otherwise(0)).over(
        Window.partitionBy(LABEL, "axis", "cell"))
    from_here = Window.partitionBy(LABEL, "axis").orderBy(F.desc("cell")).rangeBetween(
        Window.unboundedPreceding, Window.currentRow)
    both = (cells.withColumn("n_songs", songs).unionByName(
        reach.withColumnRenamed("last", "cell"), allowMissingColumns=True)
        .withColumn("n_users", F.sum(F.coalesce("u", F.lit(0))).over(from_here)).where(F.col("page").isNotNull()))
    return both.select(
        LABEL, "axis", "cell", "page", "n_events", "n_users", "n_songs",
        (F.col("n_events") / F.col("n_users")).alias("per_user"),
        F.when(F.col("n_songs") > 0, 100.0 * F.col("n_events") / F.col("n_songs")).alias("per_hundred_songs"))

"""Event schema and the fixed values the pipeline must share with the reference.

Everything here is data, not logic: column names, label pages, column lists
and the class codes. Keep them in one place so every operator agrees.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must equal the reference for the same results) ---------
# Label pages and their class codes: 2 = cancellation, 1 = downgrade, 0 = other.
CANCEL_PAGE = "Cancellation Confirmation"
DOWNGRADE_PAGE = "Downgrade"
CLASS_OTHER, CLASS_DOWNGRADE, CLASS_CANCEL = 0, 1, 2
AT_RISK_CLASSES = (CLASS_DOWNGRADE, CLASS_CANCEL)

# Column lists used by the two wrangles and the model.
TRAIN_COLUMNS = ["userId", "gender", "itemInSession", "level", "length", "page"]
EXPLORE_COLUMNS = [
    "gender", "itemInSession", "level", "location", "length", "method",
    "page", "sessionId", "status", "ts", "userId",
]
MODEL_FEATURES = ["gender", "itemInSession", "level", "length"]
TWO_FEATURES = ["itemInSession", "length"]
STRING_FEATURES = ["gender", "level"]
LABEL = "churn"
PREDICTION = "churn_pred"

# Class balancing: k * min / count; the notebook uses k = 2, the scripts 2 * 4.3.
NOTEBOOK_BALANCE_K = 2.0
SCRIPT_BALANCE_K = 2 * 4.3
SEED = 42
# Split weights: 70 / 30, then the 30 halved into validation and test.
TRAIN_FRACTION = 0.7
VALID_FRACTION_OF_REST = 0.5
NUM_FOLDS = 3
# Hyper-parameter grids of the three training jobs.
DT_GRID = {"maxDepth": [5, 10]}
RF_GRID = {"impurity": ["gini", "entropy"], "maxDepth": [5, 10]}
GBT_GRID = {"maxDepth": [5, 10], "maxIter": [10, 20]}
GBT_MAX_ITER = 10
# --- end of fixed values ----------------------------------------------------

# The documented clickstream event (one JSON object per line). ``userId`` is a
# string in the source (logged-out rows carry ``""``); ``ts`` and
# ``registration`` are epoch milliseconds.
EVENT_SCHEMA = T.StructType([
    T.StructField("artist", T.StringType()),
    T.StructField("auth", T.StringType()),
    T.StructField("firstName", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("itemInSession", T.LongType()),
    T.StructField("lastName", T.StringType()),
    T.StructField("length", T.DoubleType()),
    T.StructField("level", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("method", T.StringType()),
    T.StructField("page", T.StringType()),
    T.StructField("registration", T.LongType()),
    T.StructField("sessionId", T.LongType()),
    T.StructField("song", T.StringType()),
    T.StructField("status", T.LongType()),
    T.StructField("ts", T.LongType()),
    T.StructField("userAgent", T.StringType()),
    T.StructField("userId", T.StringType()),
])

# Casts applied right after reading (P1): ``userId`` to bigint (an int would turn ids
# above 2,147,483,647 into nulls, and their users would be dropped), ``length`` to double.
SOURCE_CASTS = {"userId": "bigint", "length": "double"}

"""Fixed rules as Spark ML pipelines: scored, saved, loaded and compared like fitted ones."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer

from ..schema import CLASS_CANCEL, CLASS_DOWNGRADE, CLASS_OTHER, PREDICTION

_FRACTION = "length <> floor(length)"
_EVEN = "pmod(itemInSession, 2) = 0"

#: Conditions for a cancellation and for a downgrade, in this order.
RULES = {
    "fraction": (f"{_FRACTION} AND {_EVEN}", _FRACTION),
    "position": ("itemInSession >= 40", "itemInSession >= 20"),
    "nobody": ("false", "false"),
    "free": ("level = 'free' AND gender = 'F'", "level = 'free'"),
}


def rule_pipeline(name: str) -> PipelineModel:
    """A rule of ``RULES`` as a pipeline with one SQL stage."""
    cancel, downgrade = RULES[name]
    rule = (f"CASE WHEN {cancel} THEN {float(CLASS_CANCEL)}D WHEN {downgrade} THEN {float(CLASS_DOWNGRADE)}D "
            f"ELSE {float(CLASS_OTHER)}D END")
    return PipelineModel(stages=[SQLTransformer(statement=f"SELECT *, {rule} AS {PREDICTION} FROM __THIS__")])

from .columns import (churn_label, epoch_ms_date, epoch_ms_day, epoch_ms_hour,
                      epoch_ms_month, epoch_ms_year, hash_bucket, hash_fraction_bits, HASH_RANGE, prediction_correct,
                      split_states, state_of)

__all__ = [
    "churn_label", "epoch_ms_date", "epoch_ms_day", "epoch_ms_hour", "epoch_ms_month",
    "epoch_ms_year", "hash_bucket", "hash_fraction_bits", "HASH_RANGE", "prediction_correct", "split_states", "state_of",
]

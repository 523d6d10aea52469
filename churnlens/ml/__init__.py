"""Spark ML pipelines, training and evaluation."""

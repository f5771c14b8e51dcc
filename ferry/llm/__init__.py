"""Operators of a training-data pipeline, each a function on DataFrames.

Nothing else in the library imports this package; ``catalog`` registers one
query per operator. Python used inside tasks (numpy, Arrow) is partitioned and
shuffled by Spark; no stage gathers the corpus on the driver or in one task.
"""

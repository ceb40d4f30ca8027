"""Spark operators for industrial filtration sensor logs.

Every public operator takes a DataFrame and returns a DataFrame.  The log is one
row per sample, keyed by ``unit_id`` (which machine), ``us`` (microseconds since
1970) and ``seq`` (a stable tiebreak for equal stamps).
"""

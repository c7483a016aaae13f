"""Sensor-condition analytics as Spark jobs.

Readings in, checked, merged, split, learned from, scored and compared, all as
DataFrame, Spark ML and Structured Streaming work on the executors.
"""

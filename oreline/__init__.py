"""Medallion and star-schema jobs as plain PySpark.

Every operator is ``DataFrame (+ parameters) -> DataFrame``; jobs in
:mod:`oreline.plans` compose them, and :mod:`oreline.streaming` feeds the same
jobs from a file stream.
"""

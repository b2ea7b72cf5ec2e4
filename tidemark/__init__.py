"""Batch table pipelines on Spark DataFrames.

Reads named inputs, transforms them with ordinary DataFrame operators, keeps
slowly changing dimensions of types 1, 2 and 4, and checks readiness before a
job starts.
"""

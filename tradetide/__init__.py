"""Minute-level trade statistics over order and payment streams, on Spark.

Orders and payments arrive on separate topics, in any order.  The package
matches them, keeps turnover per trading platform and per terminal for every
minute, and derives the cumulative mobile-to-PC ratio, with the same DataFrame
transforms in batch jobs and in Structured Streaming jobs.
"""

"""Operators for preparing training data: dedup, quality, tokens, fingerprints, mixing.

Every operator takes a DataFrame and column names and returns a DataFrame. Python inside
tasks works on Arrow batches; Spark does the partitioning, counting and joining.
"""

"""Spark operators for barcoded single-cell sequencing reads.

Every operator takes and returns DataFrames; Spark plans, shuffles and spills.
"""

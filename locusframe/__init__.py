"""locusframe: genome-region data processing written as plain PySpark DataFrame plans.

Sub-packages
------------
``functions``  Column expressions (intervals, lines, genotype statistics).
``sources``    Readers and region layouts.
``operators``  Region assignment, placement, indexing, parsing, sinks.
``plans``      Named queries over the driver tables and their SQL checks.
"""

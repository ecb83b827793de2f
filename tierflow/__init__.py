"""Tiered cleaning, roll-up and star-schema building on Spark DataFrames.

Every operator takes and returns DataFrames (or Columns) and only extends the
logical plan; reads, writes and counts live in ``tierflow.sources`` and in the
``refresh`` and ``batch`` modules of ``tierflow.plans``.
"""

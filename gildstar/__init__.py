"""Bronze -> silver -> gold star-schema building blocks on Spark DataFrames.

Every operator takes DataFrames (or Columns) and returns DataFrames (or
Columns).  Layout:

* ``functions``  Column -> Column helpers
* ``operators``  DataFrame -> DataFrame operators
* ``sources``    bronze tables, table sinks and input derived from TPC-H-ish tables
* ``plans``      the thirteen staging / intermediate / gold dataflows and their checks
* ``streaming``  the same incremental loads fed by Structured Streaming
* ``queries``    registered queries with their SQL counterparts

Identifiers such as ``W1`` or ``M10`` in docstrings are the operator ids of
"""

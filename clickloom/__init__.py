"""Click-stream analytics as Spark DataFrame operators.

Every public operator takes DataFrames (or Columns) and returns DataFrames;
Spark plans, partitions and shuffles the work.
"""

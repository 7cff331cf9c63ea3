"""tessera: analytics operators for PySpark, written as DataFrame -> DataFrame functions.

Sub-packages:
  functions  Column-expression builders (Java-compatible split/trim, int parsing, dates)
  sources    readers and record parsers that return (good, rejected) DataFrames
  operators  relational, text, graph, ML, sink and catalog operators
  plans      the stand-in datasets built from the test tables and the registered queries
  streaming  Structured Streaming pipelines (per-batch counts, partitioned ETL, scoring)
"""

from tessera.session import cluster_conf, get_spark, intermediates, shared_dir

__all__ = ["cluster_conf", "get_spark", "intermediates", "shared_dir"]

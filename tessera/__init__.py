"""tessera — parameterised PySpark analytics: DataFrame in, DataFrame out.

Sub-packages:

* ``sources``   readers for delimited text, header CSV, word lists, JSON documents, table sets
* ``sinks``     writers for text lines, TSV, single-file CSV, keyed documents
* ``functions`` column expressions (text cleaning, time, buckets, detections, payloads)
* ``operators`` relational building blocks (filters, joins, aggregates, ranking)
* ``plans``     named analytics composed from the operators, plus the driver-table queries
* ``streaming`` Structured Streaming stages for the frame/detection stream
"""

from tessera.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]

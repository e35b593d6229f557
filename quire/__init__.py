"""quire: a text-corpus engine expressed as Spark DataFrame jobs.

Layout
------
functions/  column expressions (markup to text, ids, dates, spans)
operators/  DataFrame -> DataFrame operators (ledger, links, annotation, ...)
sources/    readers: item feeds, JSON pages, HTML tree extraction, CSV
sinks/      versioned table writes, stand-off export
streaming/  Structured Streaming ingest (foreachBatch + ledger)
plans/      named end-to-end queries over the driver tables
"""

__version__ = "0.1.0"

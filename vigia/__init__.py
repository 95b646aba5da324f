"""vigia: alert collection and reporting as Spark DataFrame operators.

Layout:
  functions/  pure Column expressions (text, dates, urls)
  sources/    scans: history CSV/Parquet, rules, feeds, fetched pages
  operators/  HTML shredding, selection, cards, history, content, notify, report, errors
  plans/      end-to-end job and the query builders registered in __spark_entry__
  streaming/  incremental novelty with Structured Streaming
"""

__all__ = ["session"]

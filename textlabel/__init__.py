"""textlabel: labelled-text corpus analytics as Spark DataFrame jobs.

Layout:
  functions/  pure Column -> Column expressions (text, arrays, labels, JSON)
  operators/  DataFrame -> DataFrame jobs (vocabulary, splits, profiling, metrics, models)
  sources/    corpus readers and result writers
  plans/      end-to-end pipelines and the derivations used on the driver tables
  streaming/  the stateless per-row operators applied to a streaming DataFrame
"""

__version__ = "0.1.0"

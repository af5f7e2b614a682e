"""larder: restaurant sales and operations analytics on Spark.

Layers: ``sources`` (tables, raw files, adapters), ``streaming`` (file ingest),
``functions`` (exact money and calendar expressions), ``operators`` (cleaning,
distributed ranking and quantiles, audits), ``plans`` (silver, dimensions,
facts, marts, gold refresh and the registered queries).
"""

__version__ = "0.1.0"

"""petitionlens: petition-record analytics as Spark DataFrame plans.

Entry points:

* ``plans.ingest.ingest``: RAW CSV or table -> clean -> Parquet (one job).
* ``plans.ingest.run_catalogue``: every analysis over the clean table,
  one scan per group-by key (``plans.shared``); ``plans.report.report``
  renders the previews, ``sources.write_answers`` stores the answers.
* ``plans.catalogue``: the named analyses one at a time (``CATALOGUE``).
* ``operators``: the generic operators they are built from.
* ``streaming.ingest_available``: the ingest job over newly landed files.

Nothing here creates a SparkSession; everything takes one (or a DataFrame).
"""

__version__ = "0.1.0"

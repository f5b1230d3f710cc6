"""stratum: layered lakehouse analytics (landing -> bronze -> silver -> gold) on Spark.

Everything is expressed with the DataFrame / SQL API and Structured Streaming:

* ``stratum.functions``  column helpers (UUID text, epoch conversions, money casts, ratios)
* ``stratum.operators``  batch operators (projection checks, SCD1/SCD2, data quality,
                         distributed percent rank, latest-per-key)
* ``stratum.sources``    incremental file ingest with schema evolution and lineage
* ``stratum.streaming``  append and change-data-capture flows driven by ``foreachBatch``
* ``stratum.plans``      gold views, month landing, the end-to-end pipeline
"""

__version__ = "0.1.0"

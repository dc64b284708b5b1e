"""tessera: image dataset preparation as Spark DataFrame plans.

Entry points: ``tessera.plans.run.run_pipeline`` (batch job),
``tessera.streaming.ingest.ingest`` (incremental ingest),
``tessera.plans.cli`` (command line).
"""

__version__ = "0.1.0"

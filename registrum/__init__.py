"""registrum: company-registry medallion analytics on Spark.

Bronze (idempotent, insert-only ingestion), Silver (incremental clean, enrich,
last-wins merge, schema gate) and Gold (master table and KPIs), plus profiling,
quality and sampling reports. Every job is a DataFrame plan; nothing passes
through the driver except counts, marks and small reports.
"""

from registrum.spec import ESTABLISHMENTS, LEGAL_UNITS, DatasetSpec, spec_for

__all__ = ["ESTABLISHMENTS", "LEGAL_UNITS", "DatasetSpec", "spec_for"]

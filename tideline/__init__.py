"""tideline: message-log ingestion on Spark.

Landed message envelopes are deduplicated, decoded, merged with their
attributes, turned into typed rows, classified (processed / unparseable /
thrown away), rolled up and written to time-segmented tables.  Every step
is a DataFrame -> DataFrame function, so the same plan serves a batch
reload (``spark.read``) and a running stream (``spark.readStream``).
"""

from tideline.spec import IngestSpec  # noqa: F401

__all__ = ["IngestSpec"]

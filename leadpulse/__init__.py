"""leadpulse: daily sales-lead metrics on Spark, for tables and streams.

Leads arrive as JSON messages (``value STRING, ingest_ts TIMESTAMP``). They
are parsed once into typed columns, bad messages are set aside, and the
daily counters (total, new to the brand, new to the dealer, and by source x
region x province) are computed with DataFrame built-ins, in batch or as a
Structured Streaming query with state kept in the checkpoint.
"""

from leadpulse.schema import DIMS, LEAD_FIELDS, LEAD_SCHEMA
from leadpulse.session import build_session, scratch_dir

__all__ = ["DIMS", "LEAD_FIELDS", "LEAD_SCHEMA", "build_session", "scratch_dir"]

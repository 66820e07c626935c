"""Incremental form of the staging step.

The source pipeline is full-refresh batch only (no watermark, window or
state anywhere). The one piece that benefits from running incrementally is
the first: turning newly arrived declaration files into staging rows. The
staging transform is a stateless select/filter, so the same
``stg_declarations`` builder runs unchanged on a file stream; every batch
mart downstream then reads the staging table.
"""

from sunlight.streaming.staging import declaration_schema, start_rejected_stream, start_staging_stream

__all__ = ["start_staging_stream", "start_rejected_stream", "declaration_schema"]

"""Structured Streaming versions of ingestion, change detection and counts.

Event time must be a zoned timestamp, so streams carry ``observed_at`` as
``timestamp`` and results are cast back; pin the session zone to UTC (as
:func:`pricetide.session.build_session` does).
"""

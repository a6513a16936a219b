"""Moored-buoy telemetry on Spark: ingest, derive, bin, quality-check, publish.

Every operator is keyed by ``(site, deployment)``, so one job serves any number
of stations, deployments and years.  Timestamps are ``TIMESTAMP_NTZ`` holding
UTC, which keeps results independent of the session time zone.
"""

__version__ = "0.1.0"

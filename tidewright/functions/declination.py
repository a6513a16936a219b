"""Magnetic declination: from field components, or from a dated dimension."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewright.functions.timegrid import interval_seconds

SECONDS_PER_YEAR = 365.25 * 86400.0


def declination_angle(b_east: Column, b_north: Column) -> Column:
    """Angle of the horizontal field from true north, positive east, in degrees."""
    return F.degrees(F.atan2(b_east, b_north))


def declination_at(decl_deg: Column, rate_deg_per_year: Column, ref_date: Column, date: Column) -> Column:
    """Declination at ``date``, linear in time around ``ref_date``."""
    return decl_deg + rate_deg_per_year * (interval_seconds(date - ref_date) / SECONDS_PER_YEAR)

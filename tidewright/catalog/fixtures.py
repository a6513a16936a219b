"""Dimensions of the registered queries, shared by their Spark and SQL forms."""

# Declination per station: (site, ref_date, degrees, degrees per year).  The value
# of CE02 is published; those of the other stations, and all rates, are MADE UP.
DECLINATIONS = [
    ("CE02", "2026-01-01 00:00:00", 14.602, -0.1),
    ("CE04", "2026-01-01 00:00:00", 14.8, -0.1),
    ("CE07", "2026-01-01 00:00:00", 15.4, -0.09),
    ("CE09", "2026-01-01 00:00:00", 15.6, -0.09),
]

# Progress: (site, deployment, last_bin_end, run_id, cleared).  CE02 resumes, CE04
# was cleared, CE07 never ran, CE09 resumes off the clock's grid within its last day.
PROGRESS = [
    ("CE02", "D00001", "2024-01-05 00:00:00", 1, False),
    ("CE02", "D00001", "2024-01-10 06:00:00", 2, False),
    ("CE04", "D00001", "2024-01-12 00:00:00", 1, False),
    ("CE04", "D00001", None, 2, True),
    ("CE09", "D00001", "2024-01-30 02:05:00", 1, False),
]

#: Time of the run; it falls on a day with data.
AS_OF = "2024-01-30 21:00:00"
#: Fixed date of the rotation, where a query sets one.
ALPHA_DATE = "2025-06-01 00:00:00"

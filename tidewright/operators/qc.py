"""Range checks on binned variables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.model import QC_BOUNDS


def apply_qc(df: DataFrame, bounds: dict[str, tuple[float, float]] = QC_BOUNDS) -> DataFrame:
    """Blank values outside their inclusive bounds; absent columns are skipped."""
    return df.withColumns(
        {
            c: F.expr(f"CASE WHEN {c} BETWEEN {lo!r}D AND {hi!r}D THEN {c} END")
            for c, (lo, hi) in bounds.items()
            if c in df.columns
        }
    )

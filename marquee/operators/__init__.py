"""Reusable relational operators built from DataFrame/Column primitives."""

from marquee.operators.shares import share_of_total, share_within, running_total
from marquee.operators.pairs import weighted_pairs
from marquee.operators.prefix import positions, running_total_by_range
from marquee.operators.distribution import distribution_by_selection, distribution_summary
from marquee.operators.profile import null_profile, unpivot_counts
from marquee.operators.selection import exact_quantiles
from marquee.operators.sketches import distinct_from_sketches, file_sketches

__all__ = [
    "share_of_total", "share_within", "running_total", "running_total_by_range",
    "positions", "weighted_pairs",
    "distribution_summary", "distribution_by_selection", "exact_quantiles", "file_sketches",
    "distinct_from_sketches", "null_profile", "unpivot_counts",
]

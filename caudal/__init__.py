"""caudal: coverage, climate and socioeconomic analytics as Spark DataFrame plans."""

from caudal.functions.bands import band, quadrant, signed_band
from caudal.functions.dates import year_of_key
from caudal.functions.numeric import clip, gap, minmax_norm, safe_corr, weighted_index
from caudal.functions.text import stable_key
from caudal.operators.aggregates import (
    annual_rollup, conditional_sum, distribution, first_last_change, monthly_rollup, pivot_values, rollup_total, share_of_levels, trend_class,
)
from caudal.operators.filters import clip_to_range, keep_matching
from caudal.operators.joins import anchor_dates, attach, with_group_stats
from caudal.operators.model import build_calendar, build_dim, build_fact
from caudal.operators.profile import describe_by, null_counts_by, profile, size_report
from caudal.operators.projection import Contract, Field, conform
from caudal.operators.quality import dq_report, duplicate_rows, repeated_keys, unresolved_keys
from caudal.operators.windows import quantiles_by, rank_by, scale_to_max, top_1, top_k, yoy_delta
from caudal.plans.kpis import KPIS, Pick
from caudal.sources.readers import flatten_arrays, flatten_pages, read_delimited, read_glob, read_roots, read_table, slice_period
from caudal.sources.writers import Sink, write_partitions, write_table

__all__ = [
    "KPIS", "Contract", "Field", "Pick", "Sink", "anchor_dates", "annual_rollup", "attach", "band", "build_calendar", "build_dim",
    "build_fact", "clip", "clip_to_range", "conditional_sum", "conform", "describe_by", "distribution", "dq_report", "duplicate_rows",
    "first_last_change", "flatten_arrays", "flatten_pages", "gap", "keep_matching", "minmax_norm", "monthly_rollup", "null_counts_by",
    "pivot_values", "profile", "quadrant", "quantiles_by", "rank_by", "read_delimited", "read_glob", "read_roots", "read_table",
    "repeated_keys", "rollup_total", "safe_corr", "scale_to_max", "share_of_levels", "signed_band", "size_report", "slice_period",
    "stable_key", "top_1", "top_k", "trend_class", "unresolved_keys", "weighted_index", "with_group_stats", "write_partitions",
    "write_table", "year_of_key", "yoy_delta",
]

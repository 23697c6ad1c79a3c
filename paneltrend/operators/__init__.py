"""Panel operators: each takes DataFrames and returns a lazy DataFrame."""

from .backfill import Rebuilt, changed_days, compare_again, key_month_digests, roll_again
from .compare import compare_periods, compare_wide, with_previous
from .criteria import criteria_summary
from .cutoffs import (
    Calendar,
    anchor_pair,
    cut_to_lag,
    cut_to_lag_by_key,
    cut_to_weekday,
    mondays_as_of,
    newest_date,
    newest_date_on,
    on_date_or_newest,
    thin_to_newest_weekday,
    thin_to_weekday,
    trailing_period,
)
from .derive import (
    against_testing_targets,
    age_bands,
    daily_vaccinations,
    drop_unkeyed,
    first_difference,
    hospital_measures,
    override_by_key,
    positive_and_negative_tests,
    reported_sums,
    seven_day_ratios,
    vaccination_rates,
)
from .drift import bucket_digests, dimension_drift, drift_counts, drift_report, has_drifted, located_drift
from .latest import latest_per_key
from .merge import in_key_set, lookup, merge_panels, repeated_keys, site_bridge
from .positions import positioned, with_earlier
from .periods import period_table
from .recency import change_since
from .reshape import stack
from .rolling import rolling_max, rolling_summary

"""strata: medallion load operators (bronze, silver, SCD1/SCD2 gold, facts) for PySpark.

Operators are plain ``DataFrame -> DataFrame`` functions; the layer loads in
``strata.plans`` add the table writes and contracts around them.
"""

from strata.operators.checks import ContractError, active_unique, enforce, grain, orphans
from strata.operators.cleanse import cleanse_strings
from strata.operators.dedup import latest_per_key, split_null_keys
from strata.operators.effective_join import resolve
from strata.operators.scd import scd1, scd2, scd2_replay
from strata.operators.surrogate import assign_surrogate, number_scan

__all__ = [
    "ContractError", "active_unique", "assign_surrogate", "cleanse_strings", "enforce", "grain",
    "latest_per_key", "number_scan", "orphans", "resolve", "scd1", "scd2", "scd2_replay",
    "split_null_keys",
]

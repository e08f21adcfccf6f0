"""Column expressions shared by the operators (all JVM-side built-ins)."""

from strata.functions.fingerprint import hash_diff
from strata.functions.keys import any_null, parse_keys
from strata.functions.text import cleanse

__all__ = ["cleanse", "hash_diff", "parse_keys", "any_null"]

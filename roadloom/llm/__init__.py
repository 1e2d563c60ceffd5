"""Operators that prepare training data: grouping, splitting, packing, leakage and shared spans. Nothing outside this
subpackage imports it."""

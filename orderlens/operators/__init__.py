"""Reusable DataFrame operators: keyed table maintenance (``keyed``) and distributed global
ordering (``rank``: row number, NTILE, exact quantiles, cumulative sums)."""

"""DataFrame -> DataFrame operators (cleaning, dedup, joins, keys, calendar, SCD2, fact, loads, checks)."""

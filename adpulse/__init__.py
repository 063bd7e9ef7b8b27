"""Ad-engagement metrics on Spark: counts, impressions per click, day-over-day change.

Every function takes and returns DataFrames; nothing runs at import time.
"""

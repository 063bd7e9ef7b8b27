"""The days the registered queries ask for; the tables cover FIRST to LAST."""

FIRST, LAST = "2024-01-01", "2024-01-30"
DAY = "2024-01-30"  # compared with the day before
GRACE_DAY = "2024-01-15"  # has landing hours on both sides
SPLIT = "2024-01-15"  # streams get the files up to here first

"""Values that the queries and their checks share."""

#: Run times, fixed so that identifiers repeat.
RUN_MILLIS = 1_735_689_600_000
SECOND_RUN_MILLIS = 1_738_368_000_000
#: Where a second load differs from the first: sheets from this month on are new in it.
SPLIT_SHEET = "S199901"
SPLIT_DATE = "1999-01-01"
#: Sheet left out as the configured exclusion.
EXCLUDED_SHEET = "S199603"
SOURCE_FILE = "complaints"

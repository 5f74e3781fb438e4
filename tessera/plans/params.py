"""Parameters the registered queries run with.

The reference hard-codes its as-of date and years for its own data
(2025-03-31, 2022 vs 2023, Jan 2025, 'comedies'/'horror movies',
'%restaurants%'); these are the same questions pointed at the shared
tables' date range and vocabulary.
"""

import datetime as dt

AS_OF = dt.date(2001, 7, 31)
ACQ_YEAR = 1995
ACQ_MONTH = 1
YEAR_A = 1996
YEAR_B = 1997
TOP_N = 10
TOP_K = 5
RECENT_K = 3
EVERY_NTH = 3
MIN_REVIEWS = 100
COMEDY = "ring"
HORROR = "anvil"
CATEGORY_PATTERN = "%restaurants%"
CHUNKS = 25
NULL_TOKENS = ("4-NOT SPECIFIED", "P")

"""Thresholds of the registered queries on the driver fixture.

The reference's thresholds assume hundreds of reviews per film; the fixture
has about 30, so the film-count thresholds are lowered (FIXTURES.md section
4). The operators take every threshold as a parameter; these are only the
values the registered queries and their SQL oracle share.
"""

# Certified films: positive share, top critics, positives (reference: 0.75, 5, 80).
CERTIFIED_RATIO = 0.75
CERTIFIED_MIN_TOP_CRITICS = 5
CERTIFIED_MIN_POSITIVE = 20
# Rotten film: NEGATIVE share above this (reference: 0.4).
NEGATIVE_SHARE = 0.4
# Minimum reviews per film (reference: 100).
MIN_POSITIVE_REVIEWS = 20
# Minimum film rows per genre (reference: 500).
MIN_GENRE_FILMS = 50
# Review years [first, end) (reference: 2020-2021; fixture orders span 1995-2001).
YEARS = (1998, 2000)

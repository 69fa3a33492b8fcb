"""KPI jobs: ``job(tables, as_of, ...) -> DataFrame``, unsorted, one per report.

``as_of`` is the report's "today"; no job reads the clock.  Ratios are doubles,
money sums are exact decimals.  Sorting is left to the reader of the result.
"""

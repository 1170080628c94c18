"""costlake: column-generic Spark operators for cost analytics.

Layout
------
``functions``  column in, column out (native expressions only)
``sources``    readers and writers for tables, reports and fitted models
``operators``  DataFrame in, DataFrame out
``plans``      ready flows that string operators together layer by layer
"""

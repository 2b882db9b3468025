"""Restaurant quality metrics as plain Spark DataFrame transforms.

``operators``  DataFrame -> DataFrame, no I/O
``sources``    readers, writers, catalog publishing
``plans``      backfill and incremental jobs over stored tables
``streaming``  the bookmarked file source that feeds the incremental jobs
``functions``  column expressions
"""

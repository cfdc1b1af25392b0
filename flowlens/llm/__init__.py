"""Training-data operators: quality rules, decontamination, secret scans,
packing, token files, page extraction, URL filters, sharding, passage and
document near-duplicates.

Nothing else in the library imports this subpackage.  ``queries.QUERIES`` and
``queries.SQL`` are picked up by ``__spark_entry__.py`` when it is present.
"""

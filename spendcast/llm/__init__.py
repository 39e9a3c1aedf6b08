"""Operators for large-scale training-data pipelines (dedup, filters, packing).

Nothing else in the library imports this subpackage.  Every operator is a
``DataFrame -> DataFrame`` function; the registered ``opN_*`` queries and their
SQL live in ``queries.py``.
"""

"""Longitudinal-record operators for PySpark.

Tables are keyed by subject and session.  Every operator is a plain function from
``DataFrame`` to ``DataFrame`` and can be used with ``df.transform(...)``.
"""

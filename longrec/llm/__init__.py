"""Operators for preparing training corpora, with their registered queries.

The rest of the library does not import this package.  Functions of this package run in
Python workers, so a cluster needs the package on its executors (``--py-files``).
"""

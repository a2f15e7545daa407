"""Operators of a training-data pipeline and their registered queries.

Nothing else in the library imports this subpackage.  Each module holds one
operator with a general interface; ``registry`` derives the registered
``opN_*`` queries from them.
"""

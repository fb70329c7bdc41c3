"""Training-data operators: ten operators over document and vector tables.

Nothing else in the library imports this subpackage.  Each operator module
has a general interface (DataFrame in, DataFrame out) and the thin query
that applies it to its table; ``registry`` lists those queries.
"""

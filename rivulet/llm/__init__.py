"""Training-data operators for large text corpora, one module per operator.

Nothing else in the library imports this package; ``__spark_entry__`` adds its
queries when the package can be imported.
"""

"""Training-data operators: ten numbered operators and their registered queries.

Nothing outside this package imports it; ``registry`` lists its queries and
``__spark_entry__.py`` adds them only when the package can be imported.
"""

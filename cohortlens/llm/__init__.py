"""Training-data operators: thirteen document operators that run as Spark jobs.

Nothing else in the library imports this subpackage. ``queries.py`` holds the
registered ``opN_<name>`` queries and their DuckDB statements.
"""

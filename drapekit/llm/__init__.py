"""Training-data operators: deduplication, scoring, filtering, formatting and token counts.

One module per operator, each a plain ``DataFrame -> DataFrame`` function; ``queries`` holds
the thin ``opN_<name>`` queries that ``__spark_entry__`` registers.
"""

"""Training-data operators: text, tokens, near-duplicates, vectors and web pages.

Nothing outside this package imports it; ``__spark_entry__`` adds its queries
when the package is present.
"""

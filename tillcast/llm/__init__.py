"""Training-data operators for large text corpora (documents, pages, benchmark, labels).

Nothing outside this package imports it; ``__spark_entry__`` registers its queries only
when the package is present.
"""

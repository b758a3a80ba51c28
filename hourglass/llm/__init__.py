"""Operators for large training-data pipelines (documents, pages, embeddings).

One module per operator with a general interface; ``queries`` registers the
thin ``opN_<name>`` queries over the driver's tables.  Nothing outside this
subpackage imports it.
"""

"""Operators for large-scale training-data pipelines, each registered as one
query ``opN_<name>`` (see ``queries.py``).  Nothing else in the library
imports this subpackage."""

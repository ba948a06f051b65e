"""Operators for preparing large text corpora, one module per operator.

``queries.py`` holds the thin registered queries, ``oracle.py`` their SQL.
Nothing outside this subpackage imports it; ``__spark_entry__`` adds its
queries only when it is present.
"""

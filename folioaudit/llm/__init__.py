"""Operators for training corpora: one module per operator, Spark-first.

Every operator takes a ``documents`` frame with ``doc_id`` and ``text`` (other
columns are ignored unless it says otherwise) and keeps its own interface. The
thin queries over whole tables are in ``queries``.
"""

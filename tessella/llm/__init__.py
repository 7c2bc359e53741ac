"""Training-data operators over a ``documents`` table (``doc_id``, ``text``, ...).

Every operator takes and returns Spark DataFrames.  The registered queries are
in :mod:`tessella.llm.queries`.
"""

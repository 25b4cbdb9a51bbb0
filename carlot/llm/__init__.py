"""Training-data operators: text in, one row per document out.

Every operator takes a DataFrame with the columns ``doc_id`` and ``text`` (others are
ignored, whatever their names), reads whole texts, treats a NULL text as an empty one and
counts every row as a document of its own.
"""

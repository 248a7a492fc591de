"""Training-data operators: search, tokenizers, archives, deduplication, extraction and language ID.

Nothing outside this folder imports it; the registered queries are in :mod:`.queries`.
"""

"""Training-data operators: ten operators over document, page and vector tables.

Nothing outside this folder, ``corpus_pipeline.py`` and the guarded part of
``__spark_entry__.py`` imports it, so the folder can be removed as a whole.
"""

"""Training-data operators: deduplication, decontamination, scans, quality
rules, archives and mixing.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.  Each
``opN_*`` module holds an operator with its own interface; ``queries.py`` binds
the operators to the given tables.
"""

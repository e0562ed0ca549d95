"""Operators for building language-model training corpora, and their registered queries.

Nothing outside this folder (and ``corpus_pipeline.py``, which counts as part of it) imports
it; ``__spark_entry__.py`` adds its queries when the folder is there.
"""

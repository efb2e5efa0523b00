"""Training-data operators.

Each module holds one operator with its own general interface; the registered
queries (:mod:`tsforge.llm.queries`) derive the digest columns from them.
Nothing outside this folder, ``corpus_pipeline.py`` and ``tests/llm`` imports it.
"""

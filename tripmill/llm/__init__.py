"""Training-data operators: fingerprints, packing, deduplication, archives, scoring, sharding.

Nothing outside this folder, ``tests/llm`` and ``corpus_pipeline.py`` imports it;
``__spark_entry__.py`` adds its queries when it is there.
"""

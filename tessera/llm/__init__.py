"""Operators for preparing language-model training corpora.

Nothing outside this package (and ``corpus_pipeline.py``) imports it. ``queries``
holds the registered queries, ``oracles`` their DuckDB SQL.
"""

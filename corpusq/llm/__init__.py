"""Operators of a training-data pipeline. Nothing outside this folder imports it.

Every operator takes DataFrames and returns DataFrames; :mod:`corpusq.llm.registry`
holds the thin ``opN_`` queries over the whole tables and their SQL.
"""

"""Operators of a training-data pipeline over documents, embeddings and pages.

Import the operator modules directly; ``sensorqc.llm.queries`` registers one named query per operator.
"""

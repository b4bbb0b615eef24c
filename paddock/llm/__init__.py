"""Operators of a large-scale training-data pipeline.

One module per operator; ``queries`` registers one thin query per operator
(and the corpus pipeline) with DuckDB SQL where SQL can express the result.
Nothing else in the library imports this subpackage.
"""

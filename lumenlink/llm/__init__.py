"""Operators for large-scale training-data pipelines.

Nothing outside this package imports it. Every operator takes a DataFrame and
the names of its id and text columns, reads only those columns (so that extra
or clashing columns cannot disturb it) and keeps its intermediate tables in the
folder that ``spark.checkpoint.dir`` names.
"""

"""quarryloom: a PySpark-native engine for corpora of Markdown documents, their chunks, vectors and labelled queries.

Every operator is a function of DataFrames (and parameters) to DataFrames. Nothing is collected to the driver
except aggregates whose size a documented bound limits.
"""

"""Keyed-stream analytics on PySpark.

Operators are plain ``DataFrame -> DataFrame`` functions.  They run on tables
and on unbounded streams alike, unless their docstring says otherwise.
"""

"""Operators for large-scale training-data pipelines.

Each module holds one operator and its thin query; ``queries`` collects them.
Nothing outside this subpackage imports it (``__spark_entry__.py`` adds its
queries when it can be imported).
"""

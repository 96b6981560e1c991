"""Operators of a training-data pipeline over ``documents`` and
``embeddings``.

Nothing outside this subpackage imports it; ``__spark_entry__.py`` registers
its queries only when it can be imported.
"""

"""Training-data operators. Nothing outside this folder imports them except
``__spark_entry__.py``, which registers their queries when they can be imported."""

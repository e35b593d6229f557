"""Operators of a training-data pipeline. Nothing else in ``quire`` imports
this subpackage; ``__spark_entry__`` adds its queries when it is present."""

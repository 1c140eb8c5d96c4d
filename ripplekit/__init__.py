"""Spark-native analytics of published posts, and operators for training text.

Every operator is a ``DataFrame -> DataFrame`` (or ``Column -> Column``)
function, so Catalyst sees the whole computation as one declarative plan.
"""

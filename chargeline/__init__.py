"""chargeline: usage mediation, rating, billing and revenue analytics on Spark.

Every stage is a pure ``DataFrame -> DataFrame`` transform parameterised by a
:class:`~chargeline.rules.Rules` object, so the same code serves batch jobs,
``foreachBatch`` micro-batches and the registered test queries.
"""

from chargeline.rules import Rules, DEFAULT_RULES

__all__ = ["Rules", "DEFAULT_RULES"]

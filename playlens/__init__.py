"""Watch-event analytics composed from Spark DataFrame operations.

Layers: raw events (``sources``) -> one wide table (``operators.silver``) -> star
schema (``operators.dims``, ``operators.fact``) -> reports (``plans``), with
quality checks on every layer (``operators.quality``) and the same parsing code
behind batch reads and the message stream (``streaming``).
"""

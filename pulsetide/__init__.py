"""Wearable-health telemetry on Spark: layers, summaries, requests, reports and checks.

Every operator is a plain ``DataFrame -> DataFrame`` function of built-in Spark
expressions. Reading and writing happen only in ``sources``, ``sinks``,
``streaming`` and ``plans``.
"""

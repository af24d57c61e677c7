"""Spark jobs and operators for hourly, bitemporal time series.

Every function takes and returns DataFrames (or Columns) and leaves execution
to Catalyst; the only actions are in ``plans.jobs``, ``sources.tables``,
``model`` and ``streaming``.
"""

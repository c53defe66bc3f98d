"""DuckDB oracle SQL: an independent, SQL-only statement of every operator.

The driver registers only the raw source tables, so each statement starts with
the binding CTEs from ``binding.BINDING_CTES``.
"""

"""Registered queries over the driver's tables, each with DuckDB SQL for the same rows."""

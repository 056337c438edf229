"""DuckDB SQL for every registered query that SQL can express, over the same given tables."""

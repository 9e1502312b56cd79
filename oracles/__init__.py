"""DuckDB SQL with the same result as each registered query."""

from oracles.queries import ORACLES

__all__ = ["ORACLES"]

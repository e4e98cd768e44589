"""DataFrame-to-DataFrame operators. None of them runs a Spark action."""

from tenorlake.operators import joins, metrics, ranking, rules, schema, tables, trends

__all__ = ["joins", "metrics", "ranking", "rules", "schema", "tables", "trends"]

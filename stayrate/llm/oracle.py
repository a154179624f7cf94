"""DuckDB SQL for the registered queries that SQL can express."""

from stayrate.llm.pii import PII_SQL

ORACLE: dict[str, str] = {"op13_pii": PII_SQL}

"""What the driver contract adds for this subpackage: its queries and their SQL."""

from creditgrade.llm.oracle import ORACLE_SQL as LLM_ORACLE_SQL
from creditgrade.llm.queries import QUERIES as LLM_QUERIES

__all__ = ["LLM_ORACLE_SQL", "LLM_QUERIES"]

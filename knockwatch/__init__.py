"""Password-guessing detection over server login logs, as Spark DataFrame jobs."""

from knockwatch.settings import RuleSettings

__all__ = ["RuleSettings"]

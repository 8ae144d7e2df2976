"""All checks: query name to (Spark query, oracle SQL or None)."""

from checks import more, tables, texts

CHECKS = {**tables.CHECKS, **texts.CHECKS, **more.CHECKS}

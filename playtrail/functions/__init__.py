"""Column-level helpers: every one is a built-in Spark expression (JVM side, codegen)."""

from playtrail.functions.scalar import *  # noqa: F401,F403

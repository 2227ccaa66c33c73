"""Column expressions shared by the operators (all JVM-side, codegen'd)."""

from adlake.functions.columns import *  # noqa: F401,F403

"""Column-expression helpers shared by every operator (JVM-side, codegen-friendly)."""

from skuflow.functions.exprs import *  # noqa: F401,F403

"""Column functions (JVM-side expressions; no Python UDFs)."""

from campo.functions.core import *  # noqa: F401,F403
from campo.functions.core import __all__  # noqa: F401

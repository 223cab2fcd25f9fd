"""Column expressions (all JVM-side built-ins; no Python runs on executors)."""

from scenaria.functions.scalar import *  # noqa: F401,F403
from scenaria.functions.scalar import __all__  # noqa: F401

"""Named queries over the driver tables; importing this package registers
all of them in ``registry.QUERIES`` / ``registry.ORACLE``."""

from . import calendars, evaluation, features, fits, forecasting, impact, models, profiling  # noqa: F401
from .registry import ORACLE, QUERIES  # noqa: F401

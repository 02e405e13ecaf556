"""wardgrid: daily place-level counts joined with sensor readings, on Spark."""

from .params import DEFAULTS, Parameters
from .session import build_session

__all__ = ["DEFAULTS", "Parameters", "build_session"]

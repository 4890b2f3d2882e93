"""Imports every module that registers checks."""

from . import alarm_checks, case_checks, evaluation_checks, feature_checks, frame_checks  # noqa: F401
from . import stream_checks, table_checks  # noqa: F401

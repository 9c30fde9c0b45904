"""Inputs: exported telemetry readers, per-project fan-in, and the mapping
from the driver's test tables to telemetry (``fixtures``)."""

from costbook.sources.telemetry import Telemetry, read_telemetry  # noqa: F401
from costbook.sources.fanin import FanInResult, fan_in  # noqa: F401

"""Sources and sinks: the driver-table bridge and the station tables."""

from climark.sources.bridge import Tables  # noqa: F401

"""Errors raised by driver-side gates."""


class StructureError(ValueError):
    """A file cannot be interpreted at all (empty, no separator, missing columns)."""


class QualityGateError(ValueError):
    """Data was read, but too much of it was rejected or a check failed."""


class PartitionError(ValueError):
    """Rows do not belong to the partition they were meant to replace."""

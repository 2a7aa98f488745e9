"""Errors a job can stop on."""


class QualityError(RuntimeError):
    """The input breaks the trip contract or a quality threshold."""


class MissingPartitionError(FileNotFoundError):
    """A month, date range or source that a step needs has not landed."""


class IngestError(RuntimeError):
    """At least one planned source file did not land."""

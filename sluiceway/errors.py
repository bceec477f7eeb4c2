"""Errors raised by the library, one per stage of a run."""


class SluicewayError(Exception):
    """Base of all errors of this library."""


class SpecError(SluicewayError):
    """The spec is incomplete or contradicts itself."""


class SourceError(SluicewayError):
    """A source cannot be read."""


class StepError(SluicewayError):
    """A step is badly configured or fails while its plan is built."""


class RuleError(SluicewayError):
    """A rule is of an unknown type or lacks a required key."""


class GateError(SluicewayError):
    """Rules failed, so nothing was written."""


class SinkError(SluicewayError):
    """A target cannot be written."""

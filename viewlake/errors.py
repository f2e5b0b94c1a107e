"""Errors that stop a stage before it publishes anything."""


class ViewlakeError(RuntimeError):
    """Base class of every error raised on purpose by this package."""


class InputError(ViewlakeError):
    """A parameter, manifest, report or ledger entry is unusable."""


class GateError(ViewlakeError):
    """The data broke a rule that blocks publishing."""

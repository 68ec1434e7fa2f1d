"""Errors raised on the driver before or between runs."""


class ConfigError(ValueError):
    """The declared job cannot be built."""


class TransformError(ValueError):
    """A transform step does not fit its input columns."""


class SchemaDriftError(RuntimeError):
    """Records left the declared schema and the policy is to halt."""


class ConnectorMissing(RuntimeError):
    """A Spark connector package is not on the class path."""

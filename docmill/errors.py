"""Expected errors; the command line reports them and exits with 1."""


class DocmillError(Exception):
    """Base of the expected errors."""


class ConfigurationError(DocmillError):
    """A setting is missing, malformed or contradictory."""


class StoreError(DocmillError):
    """The store is missing, incomplete or unreadable."""


class ContentError(DocmillError):
    """A source or stage is missing or unreadable."""


class ConflictError(DocmillError):
    """Another writer has committed in the meantime; nothing of this commit counts."""

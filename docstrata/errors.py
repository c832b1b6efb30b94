"""Errors raised while a plan is being built, before any job runs."""


class LayoutError(ValueError):
    """The documents cannot be laid out as the requested table."""


class NameClash(LayoutError):
    """Two source paths would end up under one column or table name."""

    def __init__(self, name, first, second):
        super().__init__(f"{name!r} would hold both {first!r} and {second!r}")
        self.name = name
        self.paths = (first, second)

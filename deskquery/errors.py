"""Errors of the engine. All derive from DeskQueryError."""


class DeskQueryError(Exception):
    """Base of every error this package raises."""


class QuerySyntaxError(DeskQueryError):
    """The statement does not follow the grammar."""


class UnknownTable(DeskQueryError):
    def __init__(self, name: str):
        super().__init__(f'table "{name}" not found')


class UnknownColumn(DeskQueryError):
    def __init__(self, name: str):
        super().__init__(f'column "{name}" not found in table')


class ParamError(DeskQueryError):
    """Too few, too many or unsupported parameters."""


class TypeMismatch(DeskQueryError):
    """A literal, operator or sort key does not fit the column's type."""


class ReadOnlyError(DeskQueryError):
    """Writes and transactions are not supported."""

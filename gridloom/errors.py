"""What can go wrong with a task. ContractError and RequestError end a run, the others leave the task's status to the plan."""


class ContractError(ValueError):
    """The data do not have the structure that was declared."""


class RequestError(ValueError):
    """The caller asked for something that does not exist."""


class NoDataError(LookupError):
    """There are no rows for a task."""


class IncompleteError(ConnectionError):
    """Fewer or more rows came than were advertised."""

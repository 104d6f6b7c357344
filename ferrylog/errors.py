"""Error texts for control tables."""


def first_line(error: BaseException) -> str:
    """First line of an error's message, or its type where it has none."""
    return (str(error).strip() or type(error).__name__).splitlines()[0]

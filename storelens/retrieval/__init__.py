"""Finding tables for batches of questions."""

DEFAULT_LIMIT = 5


def checked_limit(limit: int) -> int:
    """Number of tables wanted; the default for a number below one."""
    return limit if limit >= 1 else DEFAULT_LIMIT

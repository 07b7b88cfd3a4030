"""Times of test records."""

import datetime as dt

BASE = dt.datetime(2024, 1, 1)


def at(seconds: int) -> dt.datetime:
    """Timestamp ``seconds`` after a fixed base."""
    return BASE + dt.timedelta(seconds=seconds)

"""Calls to services outside of Spark: tried again when the failure may pass. Work within Spark is retried task by task."""

from __future__ import annotations

import time
from collections.abc import Callable

#: Failures of transport; what the request itself does wrong stays wrong.
PASSING = (TimeoutError, ConnectionError)


def with_retry(call: Callable, attempts: int = 4, backoff: float = 2.0, on_retry: Callable | None = None, passing: tuple = PASSING, sleep: Callable = time.sleep):
    """What call() returns. Waits backoff seconds after the first passing failure, twice as long after each other; the last one raises."""
    waits = iter([backoff * 2**k for k in range(attempts - 1)])
    tried = 0
    while True:
        tried += 1
        try:
            return call()
        except passing as failure:
            if (wait := next(waits, None)) is None:
                raise
            if on_retry:
                on_retry(tried, failure)
            sleep(wait)

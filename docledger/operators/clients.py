"""Clients and threads that outlive a task: a Python worker runs many tasks, one after the other."""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import ExitStack, contextmanager
from dataclasses import is_dataclass
from typing import Any


class _Held:
    """An opened client and the threads that call with it; closed together, threads first."""

    def __init__(self, open_client: Callable | None, concurrency: int):
        self.stack = ExitStack()
        self.client = self.stack.enter_context(open_client()) if open_client else None
        self.pool = ThreadPoolExecutor(concurrency) if concurrency > 1 else None
        if self.pool:
            self.stack.callback(self.pool.shutdown, cancel_futures=True)
        self.until = 0.0


# What this worker keeps between tasks. A worker runs one task at a time, so nothing here is shared.
_kept: dict[str, _Held] = {}


def key_of(open_client: Callable | None, concurrency: int) -> str:
    """Names a client by what it is opened with, if that can be told, so that later jobs find it too."""
    owner = getattr(open_client, "__self__", None)
    told = repr(owner) if is_dataclass(owner) else uuid.uuid4().hex
    return hashlib.sha256(f"{type(owner).__qualname__} {told} {concurrency}".encode()).hexdigest()


@contextmanager
def kept_client(open_client: Callable | None, concurrency: int, key: str = "", idle: float = 0.0,
                clock: Callable[[], float] = time.monotonic) -> Iterator[tuple[Any, ThreadPoolExecutor | None]]:
    """The client and the pool for a task.

    With ``idle`` they stay open for later tasks of this worker, unless that many seconds pass before the next
    one; a task that fails closes them. Without, they are closed with the task.
    """
    now = clock()
    for name in [name for name, held in _kept.items() if held.until < now]:
        _kept.pop(name).stack.close()
    held = _kept.pop(key, None) if idle else None
    if held is None:
        held = _Held(open_client, concurrency)
    try:
        yield held.client, held.pool
    except BaseException:
        held.stack.close()
        raise
    if idle:
        held.until = clock() + idle
        _kept[key] = held
    else:
        held.stack.close()

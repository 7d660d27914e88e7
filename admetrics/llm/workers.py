"""What a Python worker keeps between tasks: one value, that of the operator it works for.

Workers are reused by Spark, so whatever they keep adds up over the operators of an application. Here the value of the operator before goes, and its memory
with it, as soon as a task of another one asks for its own.
"""

import contextlib
import ctypes
import gc

import pyarrow as pa

_HELD = {}


def release() -> None:
    """Drops what is held and gives freed memory back to the system."""
    _HELD.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    # Only some C libraries have it.
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def held(key, make):
    """The value of `key` in this worker, made if another key was asked for last."""
    if key not in _HELD:
        release()
        _HELD[key] = make()
    return _HELD[key]

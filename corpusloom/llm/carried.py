"""What workers carry: broadcast values whose class travels with them, and their memory.

A broadcast is pickled by reference to the module of its class, which executors need not
have. A carried object sends its class by value.
"""

from __future__ import annotations

import copyreg
import ctypes

import pyarrow as pa
from pyspark import cloudpickle


class _Class:
    """Pickles as the class itself, by value."""

    def __init__(self, cls: type):
        self.cls = cls

    def __reduce__(self):
        return cloudpickle.loads, (cloudpickle.dumps(self.cls),)


class Carried:
    """Base of classes whose instances are broadcast."""

    def __reduce__(self):
        return copyreg._reconstructor, (_Class(type(self)), object, None), self.__dict__


def tidy() -> None:
    """Give back memory that a task no longer needs: its worker lives on beside those of other stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)

"""State that lives in a Python worker, across the tasks it runs."""

from __future__ import annotations

import sys
import types

from pyspark import cloudpickle

# Workers get this module's functions by value: they need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATE = "_servicelens_worker_state"


def remembered(key, make):
    """``make()`` once for each worker process and key."""
    state = sys.modules.setdefault(STATE, types.ModuleType(STATE)).__dict__
    if key not in state:
        state[key] = make()
    return state[key]

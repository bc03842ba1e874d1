"""Models for Python workers on machines that lack this package.

A broadcast value is pickled by reference: a worker would import the class from this package. So a model is broadcast as
bytes that hold its class by value, and each worker process builds it once, for all the tasks that it runs.
"""

from __future__ import annotations

import pickle
import sys

from pyspark import Broadcast, SparkContext, cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def by_value(module: str) -> None:
    """Functions of this module travel with the job."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def broadcast(context: SparkContext, model: object) -> Broadcast:
    by_value(type(model).__module__)
    return context.broadcast([cloudpickle.dumps(model)])


def received(shared: Broadcast):
    """The model behind a broadcast; the list in it is the worker's own and keeps what was built."""
    held = shared.value
    if isinstance(held[0], bytes):
        held[0] = pickle.loads(held[0])
    return held[0]

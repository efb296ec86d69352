"""Sending task code to executors that do not have this package installed."""

import sys

from pyspark import cloudpickle


def send_by_value(module_name: str) -> None:
    """Functions of the module travel whole with the job, not as a name to import."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])

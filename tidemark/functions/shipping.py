"""The package on the executors: Python workers import the helpers of the HTML jobs."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

_PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_shipped: set[str] = set()


def ship_package() -> None:
    """Send the package to the workers of the active session, once per application.

    Nothing to do where it was submitted with the application as a zip already.
    """
    context = SparkSession.active().sparkContext
    if context.applicationId in _shipped or not os.path.isdir(_PACKAGE):
        return
    root, name = os.path.split(_PACKAGE)
    target = os.path.join(tempfile.mkdtemp(prefix=f"{name}-"), name)
    context.addPyFile(shutil.make_archive(target, "zip", root, name))
    _shipped.add(context.applicationId)

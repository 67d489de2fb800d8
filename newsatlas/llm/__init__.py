"""Operators for training-data pipelines. Nothing else in the library imports this subpackage.

On a cluster without this package call :func:`ship` once, before operators get frames of your own.
"""

from .common import ship

__all__ = ["ship"]

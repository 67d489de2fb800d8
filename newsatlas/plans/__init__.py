"""The nineteen analyses and the catalog that lists them."""

from newsatlas.plans.catalog import ANALYSES, INCREMENTAL, Analysis, Bars, find, run_all

__all__ = ["ANALYSES", "INCREMENTAL", "Analysis", "Bars", "find", "run_all"]

"""Analytics over a world-news event feed, written for Spark DataFrames."""

from newsatlas.feed import Feed

__all__ = ["Feed"]

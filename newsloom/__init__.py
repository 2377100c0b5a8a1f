"""newsloom: article search and corpus analytics on Spark DataFrames."""

from newsloom.session import configure

__all__ = ["configure"]

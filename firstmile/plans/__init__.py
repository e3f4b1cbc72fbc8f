"""Jobs: the only part of the library that runs Spark actions."""

from firstmile.plans.batch import Extracts, preprocess, run, serve, transform
from firstmile.plans.explore import explore
from firstmile.plans.publish import DuplicateKeys, Published, publish, verify

__all__ = [
    "DuplicateKeys",
    "Extracts",
    "Published",
    "explore",
    "preprocess",
    "publish",
    "run",
    "serve",
    "transform",
    "verify",
]

"""Curation of linked person-level records on Spark: DataFrame functions driven by declarative specs."""

from recordloom import functions, operators, plans, sources
from recordloom.functions import *  # noqa: F403
from recordloom.operators import *  # noqa: F403
from recordloom.plans import *  # noqa: F403
from recordloom.sources import *  # noqa: F403

__all__ = [*functions.__all__, *operators.__all__, *plans.__all__, *sources.__all__]

"""Normalisation and enrichment of raw messages into events."""

from vigilake.operators.normalize.pipeline import normalize  # noqa: F401
from vigilake.operators.normalize.stage import Change, Stage, stages  # noqa: F401

"""Every operator as a named query over the test tables, with its SQL counterpart."""

from tidemill.queries import augment, curate, evaluate, lifecycle, score, sources, split, sync, track, train, transform
from tidemill.queries.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES", "augment", "curate", "evaluate", "lifecycle", "score", "sources", "split", "sync", "track", "train", "transform"]

"""Continuity checks for landed integer sequences, as PySpark DataFrame functions."""

from tidemark.errors import InputError
from tidemark.plans.continuity import Continuity, SideTopics, check_continuity, check_landed, reconcile_side_topics

__all__ = ["Continuity", "InputError", "SideTopics", "check_continuity", "check_landed", "reconcile_side_topics"]

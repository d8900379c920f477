"""Incremental runs: landing folders and log topics."""

from specflow.streaming.landing import increment_profile, land
from specflow.streaming.log_route import keyed_events, route_log, topic_events

__all__ = ["increment_profile", "keyed_events", "land", "route_log", "topic_events"]

"""Structured Streaming forms of the log reports and the session table."""

from govframe.streaming.audit_stream import (
    action_summary_stream,
    latest_sessions,
    read_log_stream,
    start_session_stream,
)
from govframe.streaming.session_state import current_sessions, session_changes_stream, start_session_changes
from govframe.streaming.session_timers import current_timed_sessions, start_timed_sessions, timed_session_stream

__all__ = [
    "action_summary_stream", "current_sessions", "current_timed_sessions", "latest_sessions", "read_log_stream", "session_changes_stream",
    "start_session_changes", "start_session_stream", "start_timed_sessions", "timed_session_stream",
]

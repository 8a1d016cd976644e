"""The click log as streams: conformed rows, event-time windows, quality counters."""

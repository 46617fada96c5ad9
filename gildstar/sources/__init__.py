"""Bronze tables, sinks, and bronze-shaped input derived from generic tables."""

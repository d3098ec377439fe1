"""File sources and sinks (``files``) and log-line reading (``text``)."""

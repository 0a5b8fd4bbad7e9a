"""Raw readers, sinks and fixture views."""

"""File sources, file sinks and external tables."""

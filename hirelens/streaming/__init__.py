"""The Bronze stream and its health metrics."""

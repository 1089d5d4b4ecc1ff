"""Readers, the CSV normaliser, catalog registration and the driver-table adapter."""

"""Loads driven by files as they arrive."""

from starmill.streaming.deliveries import load_arrived_files, load_changed_files, load_new_files

__all__ = ["load_arrived_files", "load_changed_files", "load_new_files"]

"""Presets for the school registry: diagnostics, cleaning, validation, reports."""

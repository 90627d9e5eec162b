"""Part of docmill."""

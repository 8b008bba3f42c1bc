"""Part of sequoir."""

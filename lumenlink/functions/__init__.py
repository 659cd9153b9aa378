"""Part of lumenlink."""

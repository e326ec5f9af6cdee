"""The modelled tables and the analytics tables."""

"""Chunk boundaries, splits and scans."""

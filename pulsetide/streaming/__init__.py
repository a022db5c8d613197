"""Streaming queries between the layers."""

"""Streaming queries: starting, fanning out, watching, and the stateful operators."""

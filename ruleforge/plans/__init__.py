"""Rule resolution: selection, validity windows and goto chains (metadata only)."""

from .resolution import Resolution, follow_gotos, resolve, resolve_by_id

__all__ = ["Resolution", "follow_gotos", "resolve", "resolve_by_id"]

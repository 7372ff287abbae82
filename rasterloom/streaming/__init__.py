"""The engine's tables as streams: an append log with upserts, and daily sums with late data."""

"""Connected components, as the whole library has them."""

from rasterloom.operators.components import connected_components

__all__ = ["connected_components"]

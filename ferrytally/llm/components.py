"""Connected components, as the corpus operators import them."""

from ferrytally.operators.components import components  # noqa: F401

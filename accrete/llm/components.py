"""Connected components, as the library has them."""

from accrete.operators.components import components, contract, joined_to_trees

__all__ = ["components", "contract", "joined_to_trees"]

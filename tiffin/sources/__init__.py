from tiffin.sources.catalog import Marketplace
from tiffin.sources.schema import GEN1, GEN2, GENERATIONS
from tiffin.sources.star import StarSource

__all__ = ["GEN1", "GEN2", "GENERATIONS", "Marketplace", "StarSource"]

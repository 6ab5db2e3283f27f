from tiffin.streaming import ledger, rating, refunds

__all__ = ["ledger", "rating", "refunds"]

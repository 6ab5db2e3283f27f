from tiffin.jobs import checkout, deletion, intake, ledger, quality, rating, refunds

__all__ = ["checkout", "deletion", "intake", "ledger", "quality", "rating", "refunds"]

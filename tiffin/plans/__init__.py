from tiffin.plans import analytics, audit, dashboard, paging, views

__all__ = ["analytics", "audit", "dashboard", "paging", "views"]

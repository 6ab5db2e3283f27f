from tiffin.operators.lookup import attach
from tiffin.operators.merge import keyed_update
from tiffin.operators.numbering import dense_numbers
from tiffin.operators.paging import page_after, page_of
from tiffin.operators.period import in_period
from tiffin.operators.rollups import cart_values, complaints_per_order, item_sales, paid_payments
from tiffin.operators.snapshots import snapshot_changes

__all__ = [
    "attach",
    "cart_values",
    "complaints_per_order",
    "dense_numbers",
    "in_period",
    "item_sales",
    "keyed_update",
    "page_after",
    "page_of",
    "paid_payments",
    "snapshot_changes",
]

"""Expected results of the data-quality, deletion and intake jobs as SQL."""

from __future__ import annotations

from oracle.queries import AS_OF, _out
from tiffin.sources.schema import GEN1, GEN2

MODELS = {"g1": GEN1, "g2": GEN2}


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _counts(label: str, tests, g: str = "g1") -> str:
    """One line per table and test: rows of which the test is true."""
    lines = [
        f"SELECT '{name}' AS table_name, {_text(title)} AS {label}, count(*) FILTER ({test}) AS violations FROM {g}_{name}"
        for name, table in MODELS[g].items()
        for title, test in tests(table)
    ]
    return _out(f"table_name:s {label}:s violations:l", " UNION ALL ".join(lines))


def _duplicates(g: str) -> str:
    lines = []
    for name, table in MODELS[g].items():
        for columns in (table.key, *((u,) for u in table.unique)):
            row = f"({', '.join(columns)},)" if len(columns) == 1 else f"({', '.join(columns)})"
            row = columns[0] if len(columns) == 1 else row
            lines.append(
                f"SELECT '{name}' AS table_name, '{','.join(columns)}' AS key_columns, "
                f"(SELECT count(*) FROM (SELECT 1 FROM {g}_{name} GROUP BY {', '.join(columns)} HAVING count(*) > 1)) "
                f"AS repeated_values, count(*) - count(DISTINCT {row}) AS extra_rows FROM {g}_{name}"
            )
    return _out("table_name:s key_columns:s repeated_values:l extra_rows:l", " UNION ALL ".join(lines))


def _orphans(g: str) -> str:
    lines = []
    for name, table in MODELS[g].items():
        for r in table.refs:
            mine = ", ".join(f"c.{c}" for c in r.columns)
            match = " AND ".join(f"p.{p} = c.{c}" for p, c in zip(r.parent_columns, r.columns, strict=True))
            row = f"({mine})" if len(r.columns) > 1 else mine
            filled = " AND ".join(f"c.{c} IS NOT NULL" for c in r.columns)
            lines.append(
                f"SELECT '{name}' AS table_name, '{','.join(r.columns)}' AS reference_columns, "
                f"'{r.parent}' AS parent, count(DISTINCT {row}) AS orphan_values, count(*) AS orphan_rows "
                f"FROM {g}_{name} c WHERE {filled} AND NOT EXISTS (SELECT 1 FROM {g}_{r.parent} p WHERE {match})"
            )
    return _out("table_name:s reference_columns:s parent:s orphan_values:l orphan_rows:l", " UNION ALL ".join(lines))


OLD = "SELECT OrderID FROM g1_orders WHERE Date_Time < TIMESTAMP '1997-01-01 00:00:00'"
# What is deleted: payments that brought nothing are gone before orders are purged. What is blocked: every payment counts.
COLLECTED = "(SELECT * FROM g1_payment WHERE Status IN ('Paid', 'Refunded'))"
ORDER_HOLDERS = {
    "payment": "Order_ID",
    "delivery": "OrderID",
    "complaint": "OrderID",
    "refund": "OrderID",
    "cancellation": "OrderID",
}


def _holder(table: str) -> str:
    return COLLECTED if table == "payment" else f"g1_{table}"


FREE_ORDERS = f"({OLD} " + " ".join(f"EXCEPT SELECT {c} FROM {_holder(t)}" for t, c in ORDER_HOLDERS.items()) + ")"
FREE_WALLETS = "(SELECT Wallet_ID FROM g1_wallet WHERE Balance < 0 EXCEPT SELECT Wallet_ID FROM g1_refund)"


def quality_sql() -> dict[str, str]:
    held = " UNION ALL ".join(
        f"SELECT DISTINCT {c} AS OrderID, '{t}' AS holder FROM g1_{t}" for t, c in ORDER_HOLDERS.items()
    )
    return {
        "dq1_missing_values": _counts(
            "column_name", lambda t: [(c.name, f"{c.name} IS NULL") for c in t.columns if c.required]
        ),
        "dq1_missing_values_gen2": _counts(
            "column_name", lambda t: [(c.name, f"{c.name} IS NULL") for c in t.columns if c.required], "g2"
        ),
        "dq2_duplicate_keys": _duplicates("g1"),
        "dq2_duplicate_keys_gen2": _duplicates("g2"),
        "dq3_orphan_references": _orphans("g1"),
        "dq3_orphan_references_gen2": _orphans("g2"),
        "dq4_broken_rules": _counts("rule", lambda t: [(rule, f"NOT ({rule})") for rule in t.checks]),
        "dq5_out_of_domain": _counts(
            "column_name",
            lambda t: [(c.name, f"{c.name} NOT IN {c.domain}") for c in t.columns if c.domain],
        ),
        "dq6_order_purge_deleted": _out(
            "table_name:s row_key:s",
            f"""SELECT 'orders' AS table_name, CAST(OrderID AS VARCHAR) AS row_key FROM {FREE_ORDERS}
                UNION ALL
                SELECT 'order_item', Item_ID || '/' || OrderID FROM g1_order_item
                WHERE OrderID IN {FREE_ORDERS}
                UNION ALL
                SELECT 'discount', CAST(Discount_ID AS VARCHAR) FROM g1_discount WHERE OrderID IN {FREE_ORDERS}""",
        ),
        "dq6_order_purge_blocked": _out(
            "OrderID:l needed_by:s",
            f"""SELECT OrderID, string_agg(holder, ',' ORDER BY holder) AS needed_by
                FROM ({OLD}) JOIN ({held}) USING (OrderID) GROUP BY OrderID""",
        ),
        "dq6_wallet_purge_deleted": _out(
            "table_name:s row_key:s",
            f"""SELECT 'wallet' AS table_name, CAST(Wallet_ID AS VARCHAR) AS row_key FROM {FREE_WALLETS}
                UNION ALL
                SELECT 'wallet_transaction', CAST(Transaction_ID AS VARCHAR) FROM g1_wallet_transaction
                WHERE Wallet_ID IN {FREE_WALLETS}
                UNION ALL
                SELECT 'wallet_topup', CAST(Transaction_ID AS VARCHAR) FROM g1_wallet_topup
                WHERE Wallet_ID IN {FREE_WALLETS}""",
        ),
        "dq7_cart_defaults": _out(
            "Cart_ID:l Created_At:t Status:s UserID:l",
            f"SELECT Cart_ID, {AS_OF} AS Created_At, Status, UserID FROM g1_cart",
        ),
        "dq7_menu_change_stamp": _out(
            "Item_ID:l Price:d Is_Available:b Updated_At:t",
            f"""SELECT Item_ID, CASE WHEN Is_Available THEN Price ELSE Price + 10 END AS Price, Is_Available,
                       CASE WHEN Is_Available THEN Updated_At ELSE {AS_OF} END AS Updated_At
                FROM g1_menu_item""",
        ),
    }

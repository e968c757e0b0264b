"""Small frames in the shape of the library's tables."""

import datetime as dt
from decimal import Decimal

from duebook.schemas import struct


def day(text):
    return dt.datetime.fromisoformat(text)


def frame(spark, table, rows):
    """Rows given as dicts; absent columns are NULL."""
    schema = struct(table)

    def value(field, v):
        if v is not None and field.dataType.typeName() == "decimal":
            return Decimal(str(v))
        return v

    data = [tuple(value(f, r.get(f.name)) for f in schema) for r in rows]
    return spark.createDataFrame(data, schema)


def invoice(i, customer=1, amount="100.00", paid="0", owed=None, due="2026-07-31", status="OPEN", **more):
    owed = amount if owed is None else owed
    return {
        "invoice_id": i, "invoice_number": f"N{i:04d}", "customer_id": customer, "payment_term_id": 1,
        "invoice_date": day("2026-07-01"), "due_date": day(due) if due else None,
        "invoice_amount": amount, "amount_paid": paid, "outstanding_amount": owed,
        "invoice_status": status, "dispute_flag": "N", **more,
    }


def customer(i, **more):
    return {"customer_id": i, "customer_name": f"Customer {i}", "status": "ACTIVE",
            "email": f"c{i}@example.com", "risk_category": "LOW", "current_balance": "0", **more}


def by(df, key, *columns):
    """{key: value} or {key: (values)} of a collected frame."""
    out = {}
    for r in df.collect():
        out[r[key]] = r[columns[0]] if len(columns) == 1 else tuple(r[c] for c in columns)
    return out

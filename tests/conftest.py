from __future__ import annotations

import datetime as dt
import os
import sys
from decimal import Decimal

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from spendcast.session import build_session  # noqa: E402
from spendcast.sources.transactions import TRANSACTIONS_SCHEMA  # noqa: E402

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", shuffle_partitions=8)
    yield s
    s.stop()


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def make_tx(spark, rows):
    """Transactions from tuples (order_id, product_id, quantity, order_date,
    price, customer_id, country[, line_seq]); total = quantity x price."""
    out = []
    for i, r in enumerate(rows):
        oid, pid, q, d, p, cid, country = r[:7]
        seq = r[7] if len(r) > 7 else i + 1
        price = None if p is None else Decimal(str(p)).quantize(Decimal("0.01"))
        total = None if (q is None or price is None) else (price * q).quantize(Decimal("0.01"))
        out.append((oid, pid, f"item {pid}", q, ts(d) if isinstance(d, str) else d, price, cid,
                    country, total, seq))
    schema = T.StructType(TRANSACTIONS_SCHEMA.fields + [T.StructField("line_seq", T.IntegerType())])
    return spark.createDataFrame(out, schema)

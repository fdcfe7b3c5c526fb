import sys
from datetime import date, datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ebbtide.contracts import EVENT_SCHEMA  # noqa: E402
from ebbtide.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(4, "tests", **{"spark.sql.shuffle.partitions": "4"})


@pytest.fixture(scope="session")
def make_events(spark):
    """Event rows from (customer, day, invoice, product, quantity, price, country) tuples; negative quantities are returns."""

    def build(rows):
        full = []
        for customer, day, invoice, product, quantity, price, country in rows:
            d = date.fromisoformat(day)
            full.append((invoice, product, "thing", float(quantity), float(price), quantity * float(price), datetime(d.year, d.month, d.day, 9), d, customer, country, quantity < 0))
        return spark.createDataFrame(full, EVENT_SCHEMA)

    return build


def by(frame, key):
    return {r[key]: r for r in frame.collect()}

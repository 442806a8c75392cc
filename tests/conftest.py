from __future__ import annotations

from types import SimpleNamespace

import pytest

from tradeloom.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.sql.maxMetadataStringLength": "2000",
            "spark.driver.memory": "8g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("scratch")))
    yield session
    session.stop()


# Orders (user, good) and reviews (user, good, rating) of the exact seed, by id.
ORDERS = [
    (6, 1), (6, 7), (6, 12), (7, 3), (7, 8), (7, 13), (8, 5), (8, 10), (8, 15), (9, 2), (9, 9), (9, 14), (10, 4),
    (10, 6), (10, 11), (11, 1), (11, 16), (11, 20), (12, 17), (12, 18), (13, 19), (13, 21), (14, 22), (14, 24),
    (15, 23), (15, 25),
]
REVIEWS = [
    (6, 1, 5), (7, 3, 4), (8, 5, 5), (9, 2, 3), (10, 4, 5), (11, 1, 4), (12, 17, 5), (13, 19, 4), (14, 22, 5), (15, 23, 3),
]


@pytest.fixture(scope="session")
def seed(spark):
    users = [(i, f"user {i}", "merchant" if i <= 5 else "customer") for i in range(1, 16)]
    goods = [(g, f"good {g}", (g - 1) // 5 + 1, (g - 1) // 5 + 1) for g in range(1, 26)]
    tables = {
        "users": (users, "user_id bigint, name string, user_type string"),
        "categories": ([(c, f"category {c}") for c in range(1, 11)], "caty_id bigint, name string"),
        "goods": (goods, "good_id bigint, name string, caty_id bigint, merch_id bigint"),
        "orders": ([(i + 1, u, g) for i, (u, g) in enumerate(ORDERS)], "id bigint, user_id bigint, good_id bigint"),
        "reviews": (
            [(i + 1, u, g, r, f"comment {i}") for i, (u, g, r) in enumerate(REVIEWS)],
            "id bigint, user_id bigint, good_id bigint, rating bigint, comment string",
        ),
        "purchase_history": ([(i + 1, u, i + 1) for i, (u, _) in enumerate(ORDERS)], "id bigint, user_id bigint, order_id bigint"),
        "addresses": ([(a, f"address {a}") for a in range(1, 11)], "addr_id bigint, name string"),
        "pickup_points": ([(i, i) for i in range(1, 6)], "id bigint, addr_id bigint"),
        "warehouses": ([(i, i + 5) for i in range(1, 6)], "id bigint, addr_id bigint"),
    }
    return SimpleNamespace(**{n: spark.createDataFrame(rows, schema).cache() for n, (rows, schema) in tables.items()})


def rows(df, *columns):
    """Rows as sorted tuples of the given columns."""
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()

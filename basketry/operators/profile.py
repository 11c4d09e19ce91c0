"""What the planner of the marts needs to know about the keys of the input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.operators.skew import HEAVY_ROWS, measure_keys

Source = Callable[[], DataFrame] | None

# name of a key: the table it is in, and its column
_KEYS = {"orders": ("delivered", "order_id"), "customers": ("delivered", "customer_id"),
         "reviews": ("reviews", "order_id"), "payments": ("payments", "order_id")}
# fact: the key it is about
_FACTS = {"unique_orders": "orders", "heavy_orders": "orders", "repeated_orders": "orders",
          "heavy_customers": "customers", "heavy_reviews": "reviews", "heavy_payments": "payments"}


class KeyProfile:
    """Measured facts about the keys; each is measured at its first use, several at once by `measure`.

    unique_orders: is every non-NULL order_id of delivered orders one row, exact copies aside?
    heavy_orders: [None] if very many delivered orders have no id, else [].
    repeated_orders: heavy order ids; of use only where ids are not unique.
    heavy_customers, heavy_reviews, heavy_payments: heavy customers of delivered orders, and heavy
    order ids of reviews and payments.

    The sources are functions that give delivered typed orders, reviews and payments.
    Pass known facts as keywords to skip their measurement.
    """

    def __init__(self, delivered: Source = None, reviews: Source = None,
                 payments: Source = None, heavy_rows: int = HEAVY_ROWS, **known):
        self._sources = {"delivered": delivered, "reviews": reviews, "payments": payments}
        self._heavy_rows = heavy_rows
        for name, value in known.items():
            if name not in _FACTS:
                raise TypeError(f"no such fact: {name}")
            self.__dict__[name] = value

    def __getattr__(self, fact: str):
        if fact not in _FACTS:
            raise AttributeError(fact)
        self.measure(fact)
        return self.__dict__[fact]

    def measure(self, *facts: str) -> None:
        """Measure the facts not known yet in one query; each table is read once."""
        missing = [fact for fact in facts if fact not in self.__dict__]
        if not missing:
            return
        wanted: dict[str, dict] = {}
        for name in dict.fromkeys(_FACTS[fact] for fact in missing):
            table, column = _KEYS[name]
            wanted.setdefault(table, {})[name] = F.col(column)
        of_orders = [fact for fact in missing if _FACTS[fact] == "orders"]
        found = measure_keys(
            [(self._sources[table](), keys) for table, keys in wanted.items()], self._heavy_rows,
            different=["orders"] if "unique_orders" in of_orders else [],
            only_missing=["orders"] if of_orders == ["heavy_orders"] else [])
        for fact in missing:
            keys = found[_FACTS[fact]]
            if fact == "unique_orders":
                self.__dict__[fact] = not keys.repeated
            elif fact == "heavy_orders":
                self.__dict__[fact] = [None] if keys.without_key >= self._heavy_rows else []
            else:
                self.__dict__[fact] = keys.heavy

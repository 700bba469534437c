"""Stock that a stream keeps: one state per product, movements taken in the order of their windows.

State per product: the level so far, how many windows were taken, and the units of windows that the watermark has
not passed yet. A window is taken when its timer fires, so late lines of an open window still count in it, and an alert is
raised by the same rule as `inventory.low_stock_alerts`. After every micro-batch a product that moved has a row with
its level, open windows included.

Lines are summed by window and product within each Arrow batch before they are shuffled, so a best-seller reaches its
state as a few rows a task, and its state holds one number for each open window.

Over a table all windows are taken at the end of the input. The state after each window is then a running sum over the
product's windows in order, which starts from its row of `status`: one shuffle by product and a sort, without calls to Python.

Defined results: lines without a time or of a window that was taken already are left out; a product without lines has no
row; a product that `status` lacks starts at the initial level; of several `status` rows of a product a table takes the first
by name, category and stock; one without a stock starts at the initial level.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.streaming import StatefulProcessor

from tillstream.operators.inventory import _default_name, stock_movements
from tillstream.settings import StockRules

# Tasks get the class itself, so this package need not be installed where they run.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MOVES = "window_start timestamp, window_end timestamp, product_id string, sold_quantity bigint, transaction_count bigint"
#: `kind` is `level` (after the lines so far) or `alert` (a window that brought the stock below the threshold).
CHANGES = ("kind string, product_id string, product_name string, category string, current_stock bigint, "
           "reserved_stock bigint, available_stock bigint, threshold int, event_time timestamp")
_STATE = "product_name string, category string, opening bigint, reserved bigint, known boolean, sold bigint, taken bigint"


def partial_movements(lines: DataFrame, rules: StockRules = StockRules()) -> DataFrame:
    """Units by window and product, summed within each batch of rows that a task reads."""
    placed = lines.where("timestamp IS NOT NULL").select(
        F.window("timestamp", rules.window).alias("w"), "product_id", F.col("quantity").cast("bigint").alias("quantity"),
    ).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "product_id", "quantity")

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            summed = rows.groupby(["window_start", "window_end", "product_id"], dropna=False, as_index=False).agg(
                sold_quantity=("quantity", "sum"), transaction_count=("quantity", "size"))
            yield summed

    return placed.mapInPandas(add_up, MOVES)


class StockKeeper(StatefulProcessor):
    """Takes movements from the stock of one product."""

    def __init__(self, rules: StockRules = StockRules()):
        self.initial, self.threshold = rules.initial, rules.threshold
        count, unit = rules.window.split()
        self.window = timedelta(**{unit.rstrip("s") + "s": int(count)})

    def init(self, handle) -> None:
        self.handle = handle
        self.stock = handle.getValueState("stock", _STATE)
        self.open = handle.getMapState("open", "window_start timestamp", "sold bigint")

    def close(self) -> None:
        pass

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:  # noqa: N802, N803
        row = initialState.iloc[0]
        self.stock.update((row.product_name, row.category, int(row.current_stock), int(row.reserved_stock), True, 0, 0))

    def _state(self, product: str) -> list:
        found = self.stock.get()
        return list(found) if found is not None else [f"Product {product}", "General", self.initial, 0, False, 0, 0]

    def _left(self, state: list, sold: int, windows: int) -> tuple[int, int]:
        """Current and available stock; the first movement of an unknown product is taken off unclamped."""
        _, _, opening, reserved, known, _, _ = state
        left = opening - sold
        if not known:
            return (left, left) if windows == 1 else (max(left, 0), max(left, 0))
        return (max(left, 0), max(left - reserved, 0)) if windows else (opening, opening - reserved)

    def _row(self, kind: str, product: str, state: list, current: int, available: int, at) -> dict:
        return {"kind": kind, "product_id": product, "product_name": state[0], "category": state[1], "current_stock": current,
                "reserved_stock": state[3], "available_stock": available, "threshold": self.threshold, "event_time": at}

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        product, passed = key[0], timerValues.getCurrentWatermarkInMs()
        added: dict = {}
        for part in rows:
            for start, sold in part.groupby("window_start").sold_quantity.sum().items():
                if (start + self.window).timestamp() * 1000 > passed:
                    added[start] = added.get(start, 0) + int(sold)
        if not added:
            return
        state = self._state(product)
        for start, sold in added.items():
            at = (start.to_pydatetime(),)
            if self.open.containsKey(at):
                sold += self.open.getValue(at)[0]
            else:
                self.handle.registerTimer(int((start + self.window).timestamp() * 1000))
            self.open.updateValue(at, (sold,))
        waiting = [units for _, (units,) in self.open.iterator()]
        current, available = self._left(state, state[5] + sum(waiting), state[6] + len(waiting))
        self.stock.update(tuple(state))
        yield pd.DataFrame([self._row("level", product, state, current, available, max(added))])

    def _taken(self, product: str, state: list, start, units: int) -> dict | None:
        """Takes a window's units off; the alert, if this raises one."""
        _, _, opening, reserved, known, sold, taken = state
        before, after = (max(opening - s - reserved, 0) for s in (sold, sold + units))
        state[5:] = [sold + units, taken + 1]
        if after >= self.threshold or not (known or taken):
            return None
        crossed = before >= self.threshold or (not known and taken == 1)
        return self._row("alert", product, state, after, after, start) if crossed else None

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        end = pd.Timestamp(expiredTimerInfo.getExpiryTimeInMs(), unit="ms")
        start = (end - self.window).to_pydatetime()
        units = self.open.getValue((start,))[0]
        self.open.removeKey((start,))
        state = self._state(key[0])
        raised = self._taken(key[0], state, start, units)
        self.stock.update(tuple(state))
        if raised:
            yield pd.DataFrame([raised])


def _opening(status: DataFrame) -> DataFrame:
    return status.select("product_id", F.coalesce("product_name", _default_name()).alias("product_name"),
                         F.coalesce("category", F.lit("General")).alias("category"), "current_stock",
                         F.coalesce("reserved_stock", F.lit(0)).cast("bigint").alias("reserved_stock"))


def running_stock(lines: DataFrame, status: DataFrame, rules: StockRules = StockRules()) -> DataFrame:
    """Levels and alerts (`CHANGES`) as the lines of a stream come in, from the stock in `status`."""
    if not lines.isStreaming:
        return _over_table(lines, status, rules)
    moves = partial_movements(lines, rules).withWatermark("window_start", rules.watermark)
    return moves.groupBy("product_id").transformWithStateInPandas(
        statefulProcessor=StockKeeper(rules), outputStructType=CHANGES, outputMode="Update", timeMode="EventTime",
        initialState=_opening(status).groupBy("product_id"))


def _over_table(lines: DataFrame, status: DataFrame, rules: StockRules) -> DataFrame:
    """What `StockKeeper` ends with when all windows of all lines are taken, in order."""
    moves = stock_movements(lines, rules.window).select(
        "product_id", "window_start", F.coalesce("sold_quantity", F.lit(0)).alias("units"))
    rows = moves.unionByName(_opening(status).withColumn("listed", F.lit(True)), allowMissingColumns=True)
    # A product's opening stands before its windows.
    in_order = Window.partitionBy("product_id").orderBy(
        F.asc_nulls_first("window_start"), "product_name", "category", "current_stock", "reserved_stock")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opened = F.first(F.when(F.col("listed"), F.struct("product_name", "category", "current_stock", "reserved_stock")),
                     ignorenulls=True).over(so_far)
    state = rows.select(
        "product_id", "window_start", "units", opened.alias("opened"), F.sum("units").over(so_far).alias("sold"),
        F.count("window_start").over(so_far).alias("taken"), F.lead("window_start").over(in_order).isNull().alias("last"),
    ).where("window_start IS NOT NULL").select(
        "product_id", "window_start", "units", "sold", "taken", "last",
        F.when(F.col("opened").isNull(), F.concat(F.lit("Product "), F.coalesce("product_id", F.lit("None"))))
        .otherwise(F.col("opened.product_name")).alias("product_name"),
        F.coalesce("opened.category", F.lit("General")).alias("category"),
        F.col("opened.current_stock").isNotNull().alias("known"),
        F.coalesce("opened.current_stock", F.lit(rules.initial)).cast("bigint").alias("opening"),
        F.coalesce("opened.reserved_stock", F.lit(0)).cast("bigint").alias("reserved"))
    known, left, none = F.col("known"), F.col("opening") - F.col("sold"), F.lit(0).cast("bigint")
    after = F.greatest(left - F.col("reserved"), none)
    before = F.greatest(left + F.col("units") - F.col("reserved"), none)
    crossed = (after < rules.threshold) & (known | (F.col("taken") > 1)) & (
        (before >= rules.threshold) | (~known & (F.col("taken") == 2)))
    # The first movement of an unknown product is taken off unclamped.
    fresh = F.when(F.col("taken") == 1, left).otherwise(F.greatest(left, none))

    def change(kind: str, current: Column, available: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), current.alias("current_stock"), available.alias("available_stock"))

    made = F.array(
        F.when(crossed, change("alert", after, after)),
        F.when(F.col("last"), change("level", F.when(known, F.greatest(left, none)).otherwise(fresh),
                                     F.when(known, after).otherwise(fresh))))
    return state.where(F.col("last") | crossed).withColumn("change", F.explode(made)).where("change IS NOT NULL").select(
        "change.kind", "product_id", "product_name", "category", "change.current_stock",
        F.col("reserved").alias("reserved_stock"), "change.available_stock", F.lit(rules.threshold).alias("threshold"),
        F.col("window_start").alias("event_time"))


def levels(changes: DataFrame) -> DataFrame:
    """The stock rows among the changes, with what a stock table has."""
    return changes.where("kind = 'level'").select(
        "product_id", "product_name", "category", "current_stock", "reserved_stock", "available_stock",
        F.col("event_time").alias("last_updated"))


def alerts(changes: DataFrame) -> DataFrame:
    return changes.where("kind = 'alert'").select(
        "product_id", "product_name", "category", "current_stock", "threshold",
        F.col("event_time").alias("alert_time"), F.lit("active").alias("status"))

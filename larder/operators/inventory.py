"""Recipe explosion, stock movements, restocking and reordering."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.keys import PURCHASE_ORDER_NUMBER, business_key
from larder.functions.money import amount
from larder.functions.recipes import INGREDIENT_IDS, INGREDIENTS, recipe, recipe_cost
from larder.operators.ranges import ranges_of
from larder.operators.running import running_sums

# Unit cost and reorder levels of an inventory item.
UNIT_COST = Decimal("1.00")
REORDER_QUANTITY = 50
MINIMUM_QUANTITY = 10

STORE_INGREDIENT = ["LocationID", "IngredientID"]


def recipe_items(items: DataFrame) -> DataFrame:
    """One row per item and ingredient of its recipe."""
    return items.select("ItemID", F.inline(recipe(F.col("ItemID")))).withColumnRenamed(
        "Quantity", "RecipeQuantity"
    )


def item_costs(items: DataFrame) -> DataFrame:
    """Ingredient cost of one unit of each item, worked out inside its row."""
    return items.select(
        "ItemID", recipe_cost(recipe(F.col("ItemID")), F.lit(UNIT_COST)).alias("UnitCost")
    )


def recipe_explosion(lines: DataFrame, recipes: DataFrame) -> DataFrame:
    """Ingredient consumption per item.

    Units are summed per item before they meet the recipe, so the 1:n explosion
    works on one row per item instead of one per line.
    """
    units = lines.groupBy("ItemID").agg(F.sum("Quantity").alias("Units"))
    return units.join(recipes, "ItemID", "left").select(
        "ItemID", "IngredientID", (F.col("Units") * F.col("RecipeQuantity")).alias("ConsumedQuantity")
    )


def _recipe_columns(items: DataFrame) -> DataFrame:
    """Whole hundredths of every ingredient in one unit of an item, one column each; NULL where it has none."""
    chosen = items.select("ItemID", recipe(F.col("ItemID")).alias("_recipe"))
    quantity = lambda k: F.get(F.filter("_recipe", _uses(k)), F.lit(0))["Quantity"]
    return chosen.select("ItemID", *[(quantity(k) * 100).cast("bigint").alias(f"_q{k}") for k in INGREDIENT_IDS])


def _used(lines: DataFrame, recipes: DataFrame, by: list[str]) -> DataFrame:
    """Use per ``by`` and ingredient.

    The ingredients are fixed, so a recipe is a column of quantities per
    ingredient: lines are summed as they are, one sum of whole numbers per
    ingredient, and only the sums become rows.
    """
    sums = (
        lines.join(recipes, "ItemID")
        .groupBy(*by)
        .agg(*[F.sum(F.col("_units") * F.col(f"_q{k}")).alias(f"_q{k}") for k in INGREDIENT_IDS])
    )
    quantity = lambda k: F.col(f"_q{k}").cast("decimal(20,0)") * F.lit(Decimal("0.0001"))
    rows = F.array(*[F.struct(F.lit(k).alias("IngredientID"), quantity(k).alias("UsedQuantity")) for k in INGREDIENT_IDS])
    return sums.select(*by, F.inline(rows)).where(F.col("UsedQuantity").isNotNull())


def daily_usage(lines: DataFrame, orders: DataFrame, items: DataFrame) -> DataFrame:
    """Ingredient use per store, day and ingredient."""
    dated = lines.select("OrderID", "LocationID", "ItemID", (F.col("Quantity") * 100).cast("bigint").alias("_units")).join(
        orders.select("OrderID", "OrderDateID"), "OrderID"
    )
    return _used(dated, _recipe_columns(items), ["LocationID", "OrderDateID"])


def total_usage(lines: DataFrame, items: DataFrame) -> DataFrame:
    """Ingredient use per store and ingredient, of all lines: summed per store and item before the recipe is looked up."""
    sold = lines.groupBy("LocationID", "ItemID").agg((F.sum("Quantity") * 100).cast("bigint").alias("_units"))
    return _used(sold, _recipe_columns(items), ["LocationID"])


def _uses(ingredient: int) -> Callable[[Column], Column]:
    return lambda part: part["IngredientID"] == ingredient


def running_stock(usage: DataFrame, opening: Column) -> DataFrame:
    """Stock before and after each day's use, per store and ingredient.

    Use is already summed per day, so a window group has at most one row per
    calendar day however many orders a store takes.
    """
    through_today = (
        Window.partitionBy(*STORE_INGREDIENT)
        .orderBy("OrderDateID")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        usage.withColumn("QuantityAfter", opening - F.sum("UsedQuantity").over(through_today))
        .withColumn("QuantityBefore", F.col("QuantityAfter") + F.col("UsedQuantity"))
        .withColumn("TransactionType", F.lit("Usage"))
        .withColumn("ReasonCode", F.lit("Sale"))
    )


def line_usage(lines: DataFrame, items: DataFrame) -> DataFrame:
    """Lines with the quantity of every ingredient in one unit of their item, as ``_recipe_columns``; lines of unknown items go.

    A line becomes a row for each ingredient it uses only behind the last shuffle (``stock_movements``).
    """
    return lines.join(_recipe_columns(items), "ItemID")


def stock_movements(usage: DataFrame, order: list[str], opening: Column, sample: DataFrame) -> DataFrame:
    """The stock of an ingredient in a store before and after each use: one row per line and ingredient.

    ``order`` is the sequence of the lines of a store, which all its stocks follow; lines that
    tie in it must use the same quantity. So a line is shuffled once for all its ingredients,
    each of which has its own running sum. ``sample`` holds some of the lines (``sample_of``).
    """
    used = {k: (F.col("Quantity") * _recipe_quantity(k)).cast("decimal(25,4)") for k in INGREDIENT_IDS}
    summed = running_sums(usage, ranges_of(sample, ["LocationID"], order), {f"_used{k}": used[k] for k in INGREDIENT_IDS})
    uses = [
        F.when(
            F.col(f"_q{k}").isNotNull(),
            F.struct(F.lit(k).alias("IngredientID"), used[k].alias("_use"), F.col(f"_used{k}").alias("_used")),
        )
        for k in INGREDIENT_IDS
    ]
    kept = [c for c in usage.columns if c not in [f"_q{k}" for k in INGREDIENT_IDS]]
    rows = summed.select(*kept, F.inline(F.filter(F.array(*uses), lambda use: use.isNotNull())))
    after = opening - F.col("_used")
    return (
        rows.withColumns({"QuantityAfter": after, "QuantityBefore": after + F.col("_use"), "Quantity": F.col("_use")})
        .drop("_use", "_used")
    )


def _recipe_quantity(ingredient: int) -> Column:
    return (F.col(f"_q{ingredient}").cast("decimal(6,0)") * F.lit(Decimal("0.01"))).cast("decimal(6,2)")


def ingredient_array() -> Column:
    return F.array(
        *[
            F.struct(
                F.lit(key).alias("InventoryItemID"),
                F.lit(f"INV-{key}").alias("ItemCode"),
                F.lit(name).alias("ItemName"),
                F.lit(unit).alias("UnitOfMeasure"),
            )
            for key, (_, name, unit) in enumerate(INGREDIENTS, 1)
        ]
    )


def store_items(locations: DataFrame) -> DataFrame:
    """Every inventory item in every store, exploded inside each store's row: no cross join."""
    return locations.select("LocationID", F.inline(ingredient_array())).select(
        (F.col("LocationID") * len(INGREDIENTS) + F.col("InventoryItemID")).alias("StoreInventoryID"),
        "LocationID",
        "InventoryItemID",
        "ItemName",
    )


def store_stock(locations: DataFrame, usage: DataFrame) -> DataFrame:
    """Use of every inventory item in every store, also of items never used there."""
    used = usage.groupBy(*STORE_INGREDIENT).agg(
        F.sum("UsedQuantity").alias("UsedQuantity"), F.count("*").alias("DaysUsed")
    )
    return (
        store_items(locations)
        .join(used.withColumnRenamed("IngredientID", "InventoryItemID"), ["LocationID", "InventoryItemID"], "left")
        .withColumn("UsedQuantity", F.coalesce("UsedQuantity", F.lit(0)))
        .withColumn("DaysUsed", F.coalesce("DaysUsed", F.lit(0)))
    )


def purchase_order_items(usage: DataFrame) -> DataFrame:
    """What each store has to buy to replace its use: one order per store, whole units."""
    used = usage.groupBy(*STORE_INGREDIENT).agg(F.sum("UsedQuantity").alias("UsedQuantity"))
    units = F.ceil("UsedQuantity").cast("bigint")
    return used.select(
        F.col("LocationID").alias("PurchaseOrderID"),
        business_key(PURCHASE_ORDER_NUMBER, F.col("LocationID")).alias("PurchaseOrderNumber"),
        "LocationID",
        F.col("IngredientID").alias("InventoryItemID"),
        "UsedQuantity",
        units.alias("QuantityOrdered"),
        F.lit(UNIT_COST).alias("UnitPrice"),
        (amount(units) * F.lit(UNIT_COST)).alias("LineTotal"),
    )


def purchase_totals(lines: DataFrame) -> DataFrame:
    """Total of each purchase order, the cost of the use it replaces, and the difference."""
    return (
        lines.groupBy("PurchaseOrderID")
        .agg(
            F.count("*").alias("Lines"),
            F.sum("LineTotal").alias("LinesTotal"),
            F.sum(F.col("UsedQuantity") * F.col("UnitPrice")).alias("UsedCost"),
        )
        .withColumn("Variance", F.col("LinesTotal") - F.col("UsedCost"))
    )


def reorder_report(stock: DataFrame, usage: DataFrame) -> DataFrame:
    """Store items whose stock less use is below the minimum, with what to order."""
    used = usage.groupBy(*STORE_INGREDIENT).agg(F.sum("UsedQuantity").alias("UsedQuantity"))
    remaining = F.col("RemainingQuantity")
    return (
        stock.withColumnRenamed("InventoryItemID", "IngredientID")
        .join(used, STORE_INGREDIENT, "left")
        .withColumn("UsedQuantity", F.coalesce("UsedQuantity", F.lit(0)))
        .withColumn("RemainingQuantity", F.col("QuantityOnHand") - F.col("UsedQuantity"))
        .withColumn("MinimumQuantity", amount(F.lit(MINIMUM_QUANTITY), 14, 4))
        .where(remaining < F.col("MinimumQuantity"))
        .withColumn("ReorderQuantity", F.lit(REORDER_QUANTITY))
    )

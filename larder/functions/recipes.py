"""Ingredients and the recipe of a menu item."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from larder.functions.money import amount

# Ingredient code, name, unit of measure.
INGREDIENTS = [
    ("ING-01", "Flour", "lb"),
    ("ING-02", "Beef", "lb"),
    ("ING-03", "Cheese", "lb"),
    ("ING-04", "Tomato", "lb"),
    ("ING-05", "Lettuce", "lb"),
    ("ING-06", "Oil", "gal"),
    ("ING-07", "Soda Syrup", "gal"),
]
INGREDIENT_IDS = range(1, len(INGREDIENTS) + 1)

RECIPE_TYPE = "array<struct<IngredientID:int,Quantity:decimal(6,2)>>"


def recipe(item_id: Column) -> Column:
    """The 2 to 4 ingredients of an item with their quantities (0.05 to 2.00).

    The choice ranks the fixed ingredients by a hash of item and ingredient, so
    it needs neither a random state nor a window over the items.
    """
    ranked = F.array_sort(
        F.array(
            *[
                F.struct(
                    F.md5(F.concat_ws("-", item_id.cast("string"), F.lit(str(ing)))).alias("rank"),
                    F.lit(ing).alias("IngredientID"),
                    amount((item_id * 7 + ing * 13) % 196 + 5).alias("hundredths"),
                )
                for ing in INGREDIENT_IDS
            ]
        )
    )
    chosen = F.slice(ranked, 1, (item_id % 3 + 2).cast("int"))
    return F.transform(
        chosen,
        lambda pick: F.struct(
            pick["IngredientID"].alias("IngredientID"),
            (pick["hundredths"] / 100).cast("decimal(6,2)").alias("Quantity"),
        ),
    ).cast(RECIPE_TYPE)


def recipe_cost(lines: Column, unit_cost: Column) -> Column:
    """Ingredient cost of one unit of an item: its recipe at one cost per unit."""
    return F.aggregate(
        lines,
        F.lit(0).cast("decimal(10,4)"),
        lambda total, line: (total + line["Quantity"] * unit_cost).cast("decimal(10,4)"),
    )

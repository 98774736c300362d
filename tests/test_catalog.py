from collections import Counter

import pytest
from pyspark.sql import types as T

from larder.catalog import constraints, schemas


def test_table_and_column_counts():
    tables = schemas.tables()
    assert len(tables) == 37
    assert sum(len(columns) for columns in tables.values()) == 547
    assert len({name.split(".")[0] for name in tables}) == 10


def test_type_counts():
    kinds = Counter(c.type.split("(")[0] for columns in schemas.tables().values() for c in columns)
    # 63 declared decimals and one computed column
    assert kinds["decimal"] == 64
    assert kinds["bigint"] == 26
    assert kinds["timestamp"] == 53
    assert kinds["binary"] == 5
    assert kinds["date"] == 3


def test_constraint_counts():
    assert len(constraints.references()) == 106
    assert sum(ref.parent == constraints.CALENDAR for ref in constraints.references()) == 40
    assert len(constraints.CHECKS) == 13
    beyond_primary = [k for t in schemas.tables() for k in constraints.unique_keys(t)[1:]]
    assert len([k for k in beyond_primary if len(k) == 1]) == 26
    assert len([k for k in beyond_primary if len(k) == 2]) == 2


def test_default_counts():
    values = Counter(v for t in schemas.tables() for v in schemas.defaults(t).values())
    assert values["0"] == 69  # one of them written 0.0
    assert values["1"] == 25
    assert values["current_timestamp()"] == 46
    assert values["uuid()"] == 8


def test_every_reference_names_a_catalogued_key():
    for ref in constraints.references():
        assert ref.column in [c.name for c in schemas.columns(ref.child)]
        assert ref.parent in schemas.tables()


def test_struct_type():
    struct = schemas.struct_type("store.States")
    assert struct["TaxRate"].dataType == T.DecimalType(5, 4)
    assert not struct["StateCode"].nullable
    assert schemas.primary_key("inv.Items") == "InventoryItemID"
    with pytest.raises(ValueError):
        schemas.columns("store.Nothing")


def test_columns_are_written_out():
    by_name = {c.name: c for c in schemas.columns("ord.Orders")}
    assert by_name["OrderID"].type in ("int", "bigint") and not by_name["OrderID"].nullable
    assert by_name["TotalAmount"].type.startswith("decimal")
    for table in schemas.tables():
        names = [c.name for c in schemas.columns(table)]
        assert len(set(names)) == len(names)
        for column in schemas.columns(table):
            T.DataType.fromDDL(column.type)
            if column.name.endswith("DateID") and column.name != names[0]:
                assert constraints.Reference(table, column.name, constraints.CALENDAR) in constraints.references(table)
            if column.name.startswith(("Is", "Has")) and column.name[2:3].isupper():
                assert column.type == "int"


def test_references_by_table():
    pairs = {(r.child, r.column): r.parent for r in constraints.references()}
    assert len(pairs) == 106
    assert pairs["store.Locations", "StateID"] == "store.States"
    assert pairs["ord.OrderItems", "OrderID"] == "ord.Orders"
    assert pairs["inv.PurchaseOrderItems", "InventoryItemID"] == "inv.Items"
    assert pairs["loyalty.Members", "FavoriteLocationID"] == "store.Locations"
    assert pairs["finance.DailySalesSummary", "SalesDateID"] == "dim.Calendar"
    assert pairs["emp.Employees", "SupervisorEmployeeID"] == "emp.Employees"


def test_summary_rows_are_those_of_the_stored_table(spark):
    from larder.operators import sales

    daily = spark.sql("SELECT 7 AS LocationID, 19970301 AS OrderDateID, '1997-03-01' AS CalendarDate, 1997 AS Year, 5L AS TotalOrders")
    row = sales.summary_rows(daily).first()
    assert row.asDict() == {"LocationID": 7, "TotalOrders": 5, "SummaryID": 199703010000000007, "SalesDateID": 19970301}
    assert set(row.asDict()) <= set(schemas.struct_type("finance.DailySalesSummary").names)

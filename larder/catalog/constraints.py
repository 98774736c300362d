"""References, unique keys and row rules of the catalogued tables."""

from __future__ import annotations

from dataclasses import dataclass

from larder.catalog import schemas

CALENDAR = "dim.Calendar"

# Table, column, and the table it refers to by its primary key.
REFERENCES = [
    ("store.Locations", "StateID", "store.States"),
    ("store.Locations", "OpeningDateID", "dim.Calendar"),
    ("store.Locations", "ClosingDateID", "dim.Calendar"),
    ("store.Locations", "FranchiseOwnerID", "emp.Employees"),
    ("store.OperatingHours", "LocationID", "store.Locations"),
    ("store.OperatingHours", "EffectiveDateID", "dim.Calendar"),
    ("store.OperatingHours", "ExpiryDateID", "dim.Calendar"),
    ("emp.Employees", "StateID", "store.States"),
    ("emp.Employees", "HireDateID", "dim.Calendar"),
    ("emp.Employees", "TerminationDateID", "dim.Calendar"),
    ("emp.Employees", "PositionID", "emp.Positions"),
    ("emp.Employees", "PrimaryLocationID", "store.Locations"),
    ("emp.Employees", "SupervisorEmployeeID", "emp.Employees"),
    ("emp.Schedules", "EmployeeID", "emp.Employees"),
    ("emp.Schedules", "LocationID", "store.Locations"),
    ("emp.Schedules", "ShiftDateID", "dim.Calendar"),
    ("emp.Schedules", "ApprovedBy", "emp.Employees"),
    ("emp.TimeTracking", "EmployeeID", "emp.Employees"),
    ("emp.TimeTracking", "LocationID", "store.Locations"),
    ("emp.TimeTracking", "ClockInDateID", "dim.Calendar"),
    ("emp.TimeTracking", "ClockOutDateID", "dim.Calendar"),
    ("emp.TimeTracking", "ApprovedBy", "emp.Employees"),
    ("menu.Categories", "ParentCategoryID", "menu.Categories"),
    ("menu.Items", "CategoryID", "menu.Categories"),
    ("menu.Items", "LaunchDateID", "dim.Calendar"),
    ("menu.Items", "DiscontinuedDateID", "dim.Calendar"),
    ("menu.ItemCustomizations", "ItemID", "menu.Items"),
    ("menu.ItemCustomizations", "CustomizationOptionID", "menu.CustomizationOptions"),
    ("menu.ComboMeals", "LaunchDateID", "dim.Calendar"),
    ("menu.ComboMeals", "ExpiryDateID", "dim.Calendar"),
    ("menu.ComboItems", "ComboID", "menu.ComboMeals"),
    ("menu.ComboItems", "ItemID", "menu.Items"),
    ("promo.Promotions", "StartDateID", "dim.Calendar"),
    ("promo.Promotions", "EndDateID", "dim.Calendar"),
    ("promo.PromotionItems", "PromotionID", "promo.Promotions"),
    ("promo.PromotionItems", "ItemID", "menu.Items"),
    ("promo.PromotionItems", "CategoryID", "menu.Categories"),
    ("promo.PromotionItems", "ComboID", "menu.ComboMeals"),
    ("promo.PromotionStores", "PromotionID", "promo.Promotions"),
    ("promo.PromotionStores", "LocationID", "store.Locations"),
    ("loyalty.Members", "StateID", "store.States"),
    ("loyalty.Members", "EnrollmentDateID", "dim.Calendar"),
    ("loyalty.Members", "FavoriteLocationID", "store.Locations"),
    ("loyalty.Members", "DeactivationDateID", "dim.Calendar"),
    ("loyalty.PointsTransactions", "MemberID", "loyalty.Members"),
    ("loyalty.PointsTransactions", "OrderID", "ord.Orders"),
    ("loyalty.PointsTransactions", "PromotionID", "promo.Promotions"),
    ("loyalty.PointsTransactions", "ExpiryDateID", "dim.Calendar"),
    ("loyalty.PointsTransactions", "TransactionDateID", "dim.Calendar"),
    ("loyalty.Rewards", "ItemID", "menu.Items"),
    ("loyalty.Rewards", "StartDateID", "dim.Calendar"),
    ("loyalty.Rewards", "EndDateID", "dim.Calendar"),
    ("ord.Orders", "LocationID", "store.Locations"),
    ("ord.Orders", "ChannelID", "ord.OrderChannels"),
    ("ord.Orders", "MemberID", "loyalty.Members"),
    ("ord.Orders", "OrderDateID", "dim.Calendar"),
    ("ord.Orders", "PaymentDateID", "dim.Calendar"),
    ("ord.Orders", "PreparedBy", "emp.Employees"),
    ("ord.Orders", "ProcessedBy", "emp.Employees"),
    ("ord.Orders", "EstimatedReadyDateID", "dim.Calendar"),
    ("ord.Orders", "ActualReadyDateID", "dim.Calendar"),
    ("ord.Orders", "PickupDateID", "dim.Calendar"),
    ("ord.Orders", "DriverID", "emp.Employees"),
    ("ord.Orders", "DeliveryDateID", "dim.Calendar"),
    ("ord.Orders", "PromotionID", "promo.Promotions"),
    ("ord.OrderItems", "OrderID", "ord.Orders"),
    ("ord.OrderItems", "ItemID", "menu.Items"),
    ("ord.OrderItems", "ComboID", "menu.ComboMeals"),
    ("ord.OrderItemCustomizations", "OrderItemID", "ord.OrderItems"),
    ("ord.OrderItemCustomizations", "CustomizationOptionID", "menu.CustomizationOptions"),
    ("ord.PaymentTransactions", "OrderID", "ord.Orders"),
    ("ord.PaymentTransactions", "PaymentDateID", "dim.Calendar"),
    ("ord.PaymentTransactions", "SettlementDateID", "dim.Calendar"),
    ("ord.PaymentTransactions", "ProcessedBy", "emp.Employees"),
    ("ord.OrderFeedback", "OrderID", "ord.Orders"),
    ("ord.OrderFeedback", "MemberID", "loyalty.Members"),
    ("ord.OrderFeedback", "RespondedBy", "emp.Employees"),
    ("ord.OrderFeedback", "ResponseDateID", "dim.Calendar"),
    ("inv.StoreInventory", "LocationID", "store.Locations"),
    ("inv.StoreInventory", "InventoryItemID", "inv.Items"),
    ("inv.StoreInventory", "LastRestockDateID", "dim.Calendar"),
    ("inv.StoreInventory", "LastCountDateID", "dim.Calendar"),
    ("inv.InventoryTransactions", "StoreInventoryID", "inv.StoreInventory"),
    ("inv.InventoryTransactions", "OrderID", "ord.Orders"),
    ("inv.InventoryTransactions", "TransactionDateID", "dim.Calendar"),
    ("inv.InventoryTransactions", "ProcessedBy", "emp.Employees"),
    ("inv.PurchaseOrders", "LocationID", "store.Locations"),
    ("inv.PurchaseOrders", "OrderDateID", "dim.Calendar"),
    ("inv.PurchaseOrders", "ExpectedDeliveryDateID", "dim.Calendar"),
    ("inv.PurchaseOrders", "ActualDeliveryDateID", "dim.Calendar"),
    ("inv.PurchaseOrders", "OrderedBy", "emp.Employees"),
    ("inv.PurchaseOrders", "ApprovedBy", "emp.Employees"),
    ("inv.PurchaseOrders", "ReceivedBy", "emp.Employees"),
    ("inv.PurchaseOrderItems", "PurchaseOrderID", "inv.PurchaseOrders"),
    ("inv.PurchaseOrderItems", "InventoryItemID", "inv.Items"),
    ("finance.DailySalesSummary", "LocationID", "store.Locations"),
    ("finance.DailySalesSummary", "SalesDateID", "dim.Calendar"),
    ("finance.DailySalesSummary", "ReconciledBy", "emp.Employees"),
    ("finance.DailySalesSummary", "ReconciledDateID", "dim.Calendar"),
    ("finance.StoreExpenses", "LocationID", "store.Locations"),
    ("finance.StoreExpenses", "ExpenseDateID", "dim.Calendar"),
    ("finance.StoreExpenses", "ApprovedBy", "emp.Employees"),
    ("finance.StoreExpenses", "RecordedBy", "emp.Employees"),
    ("finance.Ledger", "LedgerDateID", "dim.Calendar"),
    ("finance.Ledger", "LocationID", "store.Locations"),
    ("finance.Ledger", "OrderID", "ord.Orders"),
]

# Unique columns other than primary keys and GUIDs.
UNIQUE_COLUMNS = {
    "dim.Calendar": ["CalendarDate"],
    "store.States": ["StateCode"],
    "store.Locations": ["StoreNumber"],
    "emp.Positions": ["PositionCode"],
    "emp.Employees": ["EmployeeNumber", "Email"],
    "menu.Categories": ["CategoryCode"],
    "menu.Items": ["ItemCode"],
    "menu.ComboMeals": ["ComboCode"],
    "promo.Promotions": ["PromotionCode"],
    "loyalty.Members": ["MemberNumber", "Email"],
    "loyalty.Rewards": ["RewardCode"],
    "ord.OrderChannels": ["ChannelCode"],
    "ord.Orders": ["OrderNumber"],
    "inv.Items": ["ItemCode"],
    "inv.PurchaseOrders": ["PurchaseOrderNumber"],
    "dbo.SystemConfiguration": ["ConfigKey"],
}
UNIQUE_PAIRS = {
    "inv.StoreInventory": ("LocationID", "InventoryItemID"),
    "finance.DailySalesSummary": ("LocationID", "SalesDateID"),
}

# The row rules, as SQL over the columns of their table.
CHECKS = {
    ("emp.Employees", "CHK_Employees_HourlyRate"): "HourlyRate > 0",
    ("emp.Employees", "CHK_Employees_TerminationDate"): (
        "TerminationDateID IS NULL OR TerminationDateID >= HireDateID"
    ),
    ("menu.Items", "CHK_Items_BasePrice"): "BasePrice >= 0",
    ("promo.Promotions", "CHK_Promotions_EndDate"): "EndDateID > StartDateID",
    ("promo.Promotions", "CHK_Promotions_Discount"): (
        "(DiscountPercentage IS NULL OR (DiscountPercentage > 0 AND DiscountPercentage <= 100))"
        " AND (DiscountAmount IS NULL OR DiscountAmount >= 0)"
    ),
    ("promo.PromotionItems", "CHK_PromotionItems_OneReference"): (
        "CAST(ItemID IS NOT NULL AS INT) + CAST(CategoryID IS NOT NULL AS INT)"
        " + CAST(ComboID IS NOT NULL AS INT) = 1"
    ),
    ("ord.Orders", "CHK_Orders_TotalAmount"): "TotalAmount >= 0",
    ("ord.Orders", "CHK_Orders_SubtotalAmount"): "SubtotalAmount >= 0",
    ("ord.OrderItems", "CHK_OrderItems_Quantity"): "Quantity > 0",
    ("ord.OrderItems", "CHK_OrderItems_OneReference"): (
        "CAST(ItemID IS NOT NULL AS INT) + CAST(ComboID IS NOT NULL AS INT) = 1"
    ),
    ("ord.PaymentTransactions", "CHK_PaymentTransactions_Amount"): "Amount >= 0",
    ("ord.OrderFeedback", "CHK_OrderFeedback_OverallRating"): "OverallRating BETWEEN 1 AND 5",
    ("finance.StoreExpenses", "CHK_StoreExpenses_Amount"): "Amount >= 0",
}


@dataclass(frozen=True)
class Reference:
    child: str
    column: str
    parent: str

    @property
    def parent_key(self) -> str:
        return schemas.primary_key(self.parent)


def references(table: str | None = None) -> list[Reference]:
    """The foreign keys of one table, or of all."""
    return [Reference(*row) for row in REFERENCES if table in (None, row[0])]


def unique_keys(table: str) -> list[tuple[str, ...]]:
    """Primary key, GUIDs, declared unique columns and unique pairs of a table."""
    keys = [(schemas.primary_key(table),)]
    keys += [(c.name,) for c in schemas.columns(table) if c.name.endswith("GUID")]
    keys += [(name,) for name in UNIQUE_COLUMNS.get(table, [])]
    if table in UNIQUE_PAIRS:
        keys.append(UNIQUE_PAIRS[table])
    return keys


def checks(table: str) -> dict[str, str]:
    return {name: rule for (owner, name), rule in CHECKS.items() if owner == table}

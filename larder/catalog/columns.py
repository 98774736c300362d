"""Columns of the tables, typed.

Fixed values: names, types, nullability and defaults are the contract of the tables. The first
column of a table is its primary key.
"""

DIM_CALENDAR = """
    CalendarID int not null
    CalendarDate date not null
    Year int not null
    Quarter int not null
    Month int not null
    MonthName string not null
    Day int not null
    DayOfWeek int not null
    DayName string not null
    WeekOfYear int not null
    ISOYear int not null
    ISOWeek int not null
    IsWeekend int not null
    IsHoliday int not null default 0
    HolidayName string
    IsMonthStart int not null
    IsMonthEnd int not null
    IsQuarterStart int not null
    IsQuarterEnd int not null
    IsYearStart int not null
    IsYearEnd int not null
    FiscalYear int not null
    FiscalMonth int not null
    FiscalQuarter int not null
    DayOfYear int not null
    CreatedDate timestamp not null default current_timestamp()
"""

STORE_STATES = """
    StateID int not null
    StateCode string not null
    StateName string not null
    StateRegion string not null
    TaxRate decimal(5,4) not null default 0
    IsActive int not null default 1
    CreatedDate timestamp not null default current_timestamp()
    ModifiedDate timestamp not null default current_timestamp()
"""

STORE_LOCATIONS = """
    LocationID int not null
    LocationGUID string not null default uuid()
    StoreNumber string not null
    StoreName string not null
    AddressLine1 string not null
    AddressLine2 string
    City string not null
    StateID int not null
    ZipCode string not null
    County string
    Latitude decimal(10,8)
    Longitude decimal(11,8)
    PhoneNumber string not null
    Email string
    StoreType string not null
    HasDriveThru int not null default 1
    HasDineIn int not null default 1
    SeatingCapacity int
    OpeningDateID int not null
    ClosingDateID int
    IsActive int not null default 1
    Is24Hours int not null default 0
    IsCorporateOwned int not null default 0
    FranchiseOwnerID int
    AnnualRevenue decimal(15,2)
    MonthlyRent decimal(10,2)
    CreatedDate timestamp not null default current_timestamp()
    ModifiedDate timestamp not null default current_timestamp()
    CreatedBy string not null
    ModifiedBy string not null
"""

STORE_OPERATINGHOURS = """
    OperatingHoursID int not null
    LocationID int not null
    DayOfWeek int not null
    OpenTime string not null
    CloseTime string not null
    IsHoliday int not null default 0
    HolidayName string
    EffectiveDateID int not null
    ExpiryDateID int
    CreatedDate timestamp not null default current_timestamp()
"""

EMP_POSITIONS = """
    PositionID int not null
    PositionCode string not null
    PositionName string not null
    PositionLevel int not null
    Department string not null
    MinHourlyRate decimal(6,2) not null
    MaxHourlyRate decimal(6,2) not null
    RequiresCertification int not null default 0
    IsActive int not null default 1
    CreatedDate timestamp not null default current_timestamp()
"""

EMP_EMPLOYEES = """
    EmployeeID int not null
    EmployeeGUID string not null default uuid()
    EmployeeNumber string not null
    FirstName string not null
    MiddleName string
    LastName string not null
    DateOfBirth date not null
    SSN binary not null
    Gender string
    Email string not null
    PhoneNumber string not null
    AlternatePhone string
    EmergencyContactName string not null
    EmergencyContactPhone string not null
    AddressLine1 string not null
    AddressLine2 string
    City string not null
    StateID int not null
    ZipCode string not null
    HireDateID int not null
    TerminationDateID int
    EmploymentStatus string not null
    EmploymentType string not null
    PositionID int not null
    PrimaryLocationID int not null
    SupervisorEmployeeID int
    HourlyRate decimal(6,2) not null
    OvertimeEligible int not null default 1
    PasswordHash binary not null
    PasswordSalt binary not null
    LastLoginDate timestamp
    IsSystemAdmin int not null default 0
    IsActive int not null default 1
    CreatedDate timestamp not null default current_timestamp()
    ModifiedDate timestamp not null default current_timestamp()
    CreatedBy string not null
    ModifiedBy string not null
"""

EMP_SCHEDULES = """
    ScheduleID int not null
    EmployeeID int not null
    LocationID int not null
    ShiftDateID int not null
    StartTime string not null
    EndTime string not null
    ShiftType string not null
    BreakMinutes int not null default 30
    IsApproved int not null default 0
    ApprovedBy int
    CreatedDate timestamp not null default current_timestamp()
"""

EMP_TIMETRACKING = """
    TimeTrackingID bigint not null
    EmployeeID int not null
    LocationID int not null
    ClockInDateID int not null
    ClockInTime timestamp not null
    ClockOutDateID int
    ClockOutTime timestamp
    BreakStartTime timestamp
    BreakEndTime timestamp
    TotalHoursWorked decimal(17,6)
    IsApproved int not null default 0
    ApprovedBy int
    Notes string
    CreatedDate timestamp not null default current_timestamp()
"""

MENU_CATEGORIES = """
    CategoryID int not null
    CategoryCode string not null
    CategoryName string not null
    Description string
    DisplayOrder int not null default 0
    ImageUrl string
    IsActive int not null default 1
    ParentCategoryID int
    CreatedDate timestamp not null default current_timestamp()
    ModifiedDate timestamp not null default current_timestamp()
"""

MENU_ITEMS = """
    ItemID int not null
    ItemGUID string not null default uuid()
    ItemCode string not null
    ItemName string not null
    Description string
    CategoryID int not null
    BasePrice decimal(8,2) not null
    TaxCategory string not null default 'Food'
    Calories int
    ProteinGrams decimal(5,2)
    CarbsGrams decimal(5,2)
    FatGrams decimal(5,2)
    SodiumMg int
    ContainsDairy int not null default 0
    ContainsGluten int not null default 0
    ContainsNuts int not null default 0
    ContainsSoy int not null default 0
    ContainsEggs int not null default 0
    IsVegetarian int not null default 0
    IsVegan int not null default 0
    IsSpicy int not null default 0
    SpiceLevel int
    PrepTimeMinutes int not null default 5
    IsAvailableBreakfast int not null default 0
    IsAvailableLunch int not null default 1
    IsAvailableDinner int not null default 1
    IsAvailableLateNight int not null default 1
    IsFeatured int not null default 0
    IsNewItem int not null default 0
    ImageUrl string
    IsActive int not null default 1
    LaunchDateID int not null
    DiscontinuedDateID int
    CreatedDate timestamp not null default current_timestamp()
    ModifiedDate timestamp not null default current_timestamp()
    CreatedBy string not null
    ModifiedBy string not null
"""

MENU_CUSTOMIZATIONOPTIONS = """
    CustomizationOptionID int not null
    OptionName string not null
    OptionType string not null
    PriceAdjustment decimal(6,2) not null default 0
    CalorieAdjustment int not null default 0
    IsDefault int not null default 0
    IsActive int not null default 1
    CreatedDate timestamp not null default current_timestamp()
"""

MENU_ITEMCUSTOMIZATIONS = """
    ItemCustomizationID int not null
    ItemID int not null
    CustomizationOptionID int not null
    IsRequired int not null default 0
    MinSelection int not null default 0
    MaxSelection int not null default 1
    DisplayOrder int not null default 0
    CreatedDate timestamp not null default current_timestamp()
"""

MENU_COMBOMEALS = """
    ComboID int not null
    ComboGUID string not null default uuid()
    ComboCode string not null
    ComboName string not null
    Description string
    ComboPrice decimal(8,2) not null
    SavingsAmount decimal(6,2) not null default 0
    ImageUrl string
    IsActive int not null default 1
    LaunchDateID int not null
    ExpiryDateID int
    CreatedDate timestamp not null default current_timestamp()
"""

MENU_COMBOITEMS = """
    ComboItemID int not null
    ComboID int not null
    ItemID int not null
    Quantity int not null default 1
    IsRequired int not null default 1
    AllowSubstitution int not null default 0
    DisplayOrder int not null default 0
"""

PROMO_PROMOTIONS = """
    PromotionID int not null
    PromotionGUID string not null default uuid()
    PromotionCode string not null
    PromotionName string not null
    Description string
    PromotionType string not null
    DiscountPercentage decimal(5,2)
    DiscountAmount decimal(8,2)
    StartDateID int not null
    EndDateID int not null
    MaxUsagePerCustomer int
    MaxTotalUsage int
    CurrentUsageCount int not null default 0
    MinimumPurchaseAmount decimal(8,2)
    ApplicableChannels string not null
    ApplicableDays string
    ApplicableTimeStart string
    ApplicableTimeEnd string
    IsActive int not null default 1
    IsStackable int not null default 0
    RequiresLoyaltyMembership int not null default 0
    ImageUrl string
    TermsAndConditions string
    CreatedDate timestamp not null default current_timestamp()
    ModifiedDate timestamp not null default current_timestamp()
    CreatedBy string not null
"""

PROMO_PROMOTIONITEMS = """
    PromotionItemID int not null
    PromotionID int not null
    ItemID int
    CategoryID int
    ComboID int
    CreatedDate timestamp not null default current_timestamp()
"""

PROMO_PROMOTIONSTORES = """
    PromotionStoreID int not null
    PromotionID int not null
    LocationID int not null
    IsActive int not null default 1
    CreatedDate timestamp not null default current_timestamp()
"""

LOYALTY_MEMBERS = """
    MemberID int not null
    MemberGUID string not null default uuid()
    MemberNumber string not null
    FirstName string not null
    LastName string not null
    Email string not null
    PhoneNumber string not null
    DateOfBirth date
    AddressLine1 string
    City string
    StateID int
    ZipCode string
    EnrollmentDateID int not null
    MembershipTier string not null default 'Bronze'
    TotalPoints int not null default 0
    LifetimePoints int not null default 0
    TotalSpent decimal(12,2) not null default 0
    FavoriteLocationID int
    PreferredContactMethod string not null default 'Email'
    MarketingOptIn int not null default 1
    PasswordHash binary not null
    PasswordSalt binary not null
    LastLoginDate timestamp
    IsActive int not null default 1
    DeactivationDateID int
    DeactivationReason string
    CreatedDate timestamp not null default current_timestamp()
    ModifiedDate timestamp not null default current_timestamp()
"""

LOYALTY_POINTSTRANSACTIONS = """
    TransactionID bigint not null
    MemberID int not null
    TransactionType string not null
    Points int not null
    BalanceAfter int not null
    OrderID bigint
    PromotionID int
    Notes string
    ExpiryDateID int
    TransactionDateID int not null
    CreatedBy string
"""

LOYALTY_REWARDS = """
    RewardID int not null
    RewardCode string not null
    RewardName string not null
    Description string
    PointsCost int not null
    RewardType string not null
    ItemID int
    DiscountAmount decimal(6,2)
    ImageUrl string
    IsActive int not null default 1
    StartDateID int not null
    EndDateID int
    CreatedDate timestamp not null default current_timestamp()
"""

ORD_ORDERCHANNELS = """
    ChannelID int not null
    ChannelCode string not null
    ChannelName string not null
    IsActive int not null default 1
"""

ORD_ORDERS = """
    OrderID bigint not null
    OrderGUID string not null default uuid()
    OrderNumber string not null
    LocationID int not null
    ChannelID int not null
    MemberID int
    CustomerName string
    CustomerPhone string
    CustomerEmail string
    OrderDateID int not null
    OrderDateTime timestamp not null
    OrderStatus string not null
    OrderType string not null
    SubtotalAmount decimal(12,2) not null
    TaxAmount decimal(10,2) not null
    DiscountAmount decimal(10,2) not null default 0
    DeliveryFee decimal(8,2) not null default 0
    TipAmount decimal(8,2) not null default 0
    TotalAmount decimal(12,2) not null
    PaymentMethod string not null
    PaymentStatus string not null
    PaymentDateID int
    PreparedBy int
    ProcessedBy int
    EstimatedReadyDateID int
    ActualReadyDateID int
    PickupDateID int
    DeliveryAddress string
    DeliveryInstructions string
    DriverID int
    DeliveryDateID int
    PromotionID int
    PromoCode string
    LoyaltyPointsEarned int not null default 0
    LoyaltyPointsRedeemed int not null default 0
    SpecialInstructions string
    CreatedDate timestamp not null default current_timestamp()
    ModifiedDate timestamp not null default current_timestamp()
"""

ORD_ORDERITEMS = """
    OrderItemID bigint not null
    OrderID bigint not null
    ItemID int
    ComboID int
    ItemName string not null
    Quantity int not null default 1
    UnitPrice decimal(10,2) not null
    LineTotal decimal(12,2) not null
    SpecialInstructions string
    CreatedDate timestamp not null default current_timestamp()
"""

ORD_ORDERITEMCUSTOMIZATIONS = """
    OrderItemCustomizationID bigint not null
    OrderItemID bigint not null
    CustomizationOptionID int not null
    CustomizationName string not null
    PriceAdjustment decimal(6,2) not null default 0
    CreatedDate timestamp not null default current_timestamp()
"""

ORD_PAYMENTTRANSACTIONS = """
    PaymentTransactionID bigint not null
    TransactionGUID string not null default uuid()
    OrderID bigint not null
    PaymentDateID int not null
    PaymentTime string not null
    Amount decimal(12,2) not null
    TransactionType string not null
    TransactionStatus string not null
    CardType string
    Last4Digits string
    CardToken string
    ProcessorName string
    ProcessorTransactionID string
    AuthorizationCode string
    SettlementDateID int
    ProcessedBy int
    Notes string
    TransactionDate timestamp not null default current_timestamp()
"""

ORD_ORDERFEEDBACK = """
    FeedbackID bigint not null
    OrderID bigint not null
    MemberID int
    OverallRating int not null
    FoodQualityRating int
    ServiceRating int
    SpeedRating int
    CleanlinessRating int
    ValueRating int
    Comments string
    StaffResponse string
    RespondedBy int
    ResponseDateID int
    IsPublic int not null default 0
    IsResolved int not null default 0
    CreatedDate timestamp not null default current_timestamp()
"""

INV_ITEMS = """
    InventoryItemID int not null
    ItemCode string not null
    ItemName string not null
    Description string
    Category string not null
    UnitOfMeasure string not null
    UnitCost decimal(12,4) not null
    ReorderLevel decimal(10,2) not null
    ReorderQuantity decimal(10,2) not null
    PrimarySupplierID int
    AlternateSupplierID int
    RequiresRefrigeration int not null default 0
    RequiresFreezer int not null default 0
    ShelfLifeDays int
    IsActive int not null default 1
    CreatedDate timestamp not null default current_timestamp()
    ModifiedDate timestamp not null default current_timestamp()
"""

INV_STOREINVENTORY = """
    StoreInventoryID bigint not null
    LocationID int not null
    InventoryItemID int not null
    QuantityOnHand decimal(14,4) not null default 0
    MinimumQuantity decimal(14,4) not null
    MaximumQuantity decimal(14,4) not null
    LastRestockDateID int
    LastCountDateID int
    CreatedDate timestamp not null default current_timestamp()
    ModifiedDate timestamp not null default current_timestamp()
"""

INV_INVENTORYTRANSACTIONS = """
    TransactionID bigint not null
    StoreInventoryID bigint not null
    TransactionType string not null
    Quantity decimal(14,4) not null
    QuantityBefore decimal(14,4) not null
    QuantityAfter decimal(14,4) not null
    OrderID bigint
    ReasonCode string
    Notes string
    TransactionDateID int not null
    ProcessedBy int not null
    CreatedDate timestamp not null default current_timestamp()
"""

INV_PURCHASEORDERS = """
    PurchaseOrderID bigint not null
    PurchaseOrderNumber string not null
    LocationID int not null
    OrderDateID int not null
    ExpectedDeliveryDateID int
    ActualDeliveryDateID int
    OrderStatus string not null
    TotalAmount decimal(14,2) not null
    OrderedBy int not null
    ApprovedBy int
    ReceivedBy int
    Notes string
    CreatedDate timestamp not null default current_timestamp()
    ModifiedDate timestamp not null default current_timestamp()
"""

INV_PURCHASEORDERITEMS = """
    PurchaseOrderItemID bigint not null
    PurchaseOrderID bigint not null
    InventoryItemID int not null
    QuantityOrdered decimal(14,4) not null
    QuantityReceived decimal(14,4) not null default 0
    UnitPrice decimal(12,4) not null
    LineTotal decimal(14,2) not null
    CreatedDate timestamp not null default current_timestamp()
"""

FINANCE_DAILYSALESSUMMARY = """
    SummaryID bigint not null
    LocationID int not null
    SalesDateID int not null
    TotalOrders int not null default 0
    TotalCustomers int not null default 0
    GrossSales decimal(14,2) not null default 0
    Discounts decimal(12,2) not null default 0
    Refunds decimal(12,2) not null default 0
    NetSales decimal(14,2) not null default 0
    TaxCollected decimal(12,2) not null default 0
    InStoreSales decimal(12,2) not null default 0
    DriveThruSales decimal(12,2) not null default 0
    OnlineSales decimal(12,2) not null default 0
    DeliverySales decimal(12,2) not null default 0
    CashPayments decimal(12,2) not null default 0
    CardPayments decimal(12,2) not null default 0
    MobilePayments decimal(12,2) not null default 0
    TotalLaborHours decimal(10,2) not null default 0
    TotalLaborCost decimal(12,2) not null default 0
    CostOfGoodsSold decimal(14,2) not null default 0
    AverageOrderValue decimal(12,2) not null default 0
    AverageItemsPerOrder decimal(8,2) not null default 0
    IsReconciled int not null default 0
    ReconciledBy int
    ReconciledDateID int
    CreatedDate timestamp not null default current_timestamp()
    ModifiedDate timestamp not null default current_timestamp()
"""

FINANCE_STOREEXPENSES = """
    ExpenseID bigint not null
    LocationID int not null
    ExpenseDateID int not null
    ExpenseCategory string not null
    ExpenseDescription string not null
    Amount decimal(14,2) not null
    VendorName string
    InvoiceNumber string
    PaymentMethod string
    ApprovedBy int
    RecordedBy int not null
    CreatedDate timestamp not null default current_timestamp()
"""

FINANCE_LEDGER = """
    LedgerID bigint not null
    LedgerDateID int not null
    LocationID int
    OrderID bigint
    EntryType string not null
    Amount decimal(14,2) not null
    GLAccount string
    Notes string
    CreatedDate timestamp not null default current_timestamp()
"""

DBO_AUDITLOG = """
    AuditID bigint not null
    TableName string not null
    RecordID bigint not null
    Action string not null
    OldValues string
    NewValues string
    ChangedBy string not null
    ChangedDate timestamp not null default current_timestamp()
    IPAddress string
    ApplicationName string
"""

DBO_SYSTEMCONFIGURATION = """
    ConfigID int not null
    ConfigKey string not null
    ConfigValue string not null
    Description string
    DataType string not null default 'String'
    IsEncrypted int not null default 0
    ModifiedBy string not null
    ModifiedDate timestamp not null default current_timestamp()
"""

DBO_ERRORLOG = """
    ErrorID bigint not null
    ErrorNumber int
    ErrorSeverity int
    ErrorState int
    ErrorProcedure string
    ErrorLine int
    ErrorMessage string not null
    UserName string
    HostName string
    ApplicationName string
    ErrorDate timestamp not null default current_timestamp()
"""

TABLES = {
    "dim.Calendar": DIM_CALENDAR,
    "store.States": STORE_STATES,
    "store.Locations": STORE_LOCATIONS,
    "store.OperatingHours": STORE_OPERATINGHOURS,
    "emp.Positions": EMP_POSITIONS,
    "emp.Employees": EMP_EMPLOYEES,
    "emp.Schedules": EMP_SCHEDULES,
    "emp.TimeTracking": EMP_TIMETRACKING,
    "menu.Categories": MENU_CATEGORIES,
    "menu.Items": MENU_ITEMS,
    "menu.CustomizationOptions": MENU_CUSTOMIZATIONOPTIONS,
    "menu.ItemCustomizations": MENU_ITEMCUSTOMIZATIONS,
    "menu.ComboMeals": MENU_COMBOMEALS,
    "menu.ComboItems": MENU_COMBOITEMS,
    "promo.Promotions": PROMO_PROMOTIONS,
    "promo.PromotionItems": PROMO_PROMOTIONITEMS,
    "promo.PromotionStores": PROMO_PROMOTIONSTORES,
    "loyalty.Members": LOYALTY_MEMBERS,
    "loyalty.PointsTransactions": LOYALTY_POINTSTRANSACTIONS,
    "loyalty.Rewards": LOYALTY_REWARDS,
    "ord.OrderChannels": ORD_ORDERCHANNELS,
    "ord.Orders": ORD_ORDERS,
    "ord.OrderItems": ORD_ORDERITEMS,
    "ord.OrderItemCustomizations": ORD_ORDERITEMCUSTOMIZATIONS,
    "ord.PaymentTransactions": ORD_PAYMENTTRANSACTIONS,
    "ord.OrderFeedback": ORD_ORDERFEEDBACK,
    "inv.Items": INV_ITEMS,
    "inv.StoreInventory": INV_STOREINVENTORY,
    "inv.InventoryTransactions": INV_INVENTORYTRANSACTIONS,
    "inv.PurchaseOrders": INV_PURCHASEORDERS,
    "inv.PurchaseOrderItems": INV_PURCHASEORDERITEMS,
    "finance.DailySalesSummary": FINANCE_DAILYSALESSUMMARY,
    "finance.StoreExpenses": FINANCE_STOREEXPENSES,
    "finance.Ledger": FINANCE_LEDGER,
    "dbo.AuditLog": DBO_AUDITLOG,
    "dbo.SystemConfiguration": DBO_SYSTEMCONFIGURATION,
    "dbo.ErrorLog": DBO_ERRORLOG,
}

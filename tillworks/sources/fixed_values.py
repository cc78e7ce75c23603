"""Fixed values of the retail model: small dimensions and lookup lists."""

# Country of customers and suppliers, by nation key 0 to 24.
COUNTRIES = (
    "USA", "Canada", "Mexico",
    "UK", "Germany", "France", "Spain", "Italy", "Belgium", "Switzerland", "Austria", "Poland",
    "Sweden", "Norway", "Denmark", "Finland", "Ireland", "Portugal",
    "Brazil", "Argentina", "Venezuela",
    "Japan", "Australia", "India", "Egypt",
)

# Product categories: id, name, description.
CATEGORIES = (
    (1, "ECONOMY", "Everyday goods"),
    (2, "STANDARD", "Standard range"),
    (3, "SMALL", "Small items"),
    (4, "MEDIUM", "Medium items"),
    (5, "LARGE", "Large items"),
    (6, "PROMO", "Promotional goods"),
)

# Employees: id, last name, first name, title.
EMPLOYEES = (
    (1, "Hale", "Ruth", "Sales Representative"),
    (2, "Ortiz", "Daniel", "Vice President Sales"),
    (3, "Kim", "Joon", "Sales Representative"),
    (4, "Novak", "Petra", "Sales Representative"),
    (5, "Adeyemi", "Tunde", "Sales Manager"),
    (6, "Rossi", "Marco", "Sales Representative"),
    (7, "Lund", "Astrid", "Sales Representative"),
    (8, "Mehta", "Isha", "Sales Coordinator"),
    (9, "Dubois", "Claire", "Sales Representative"),
)

# Shippers: id, company name, phone.
SHIPPERS = (
    (1, "Rapid Parcel", "555-0101"),
    (2, "Harbour Freight Lines", "555-0102"),
    (3, "Continental Post", "555-0103"),
    (4, "Green Mile Couriers", "555-0104"),
    (5, "Summit Haulage", "555-0105"),
)

# Contact title of a customer, by market segment.
CONTACT_TITLES = {
    "BUILDING": "Owner",
    "AUTOMOBILE": "Marketing Manager",
    "MACHINERY": "Sales Representative",
    "HOUSEHOLD": "Sales Agent",
    "FURNITURE": "Order Administrator",
}

BROWSERS = ("Chrome", "Firefox", "Safari", "Edge")
DEVICES = ("desktop", "mobile", "tablet")

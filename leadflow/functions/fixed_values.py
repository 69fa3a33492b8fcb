"""Business word lists the KPIs are defined by.

They have to equal the words found in the CRM data, compared without regard
to case, so they are all written in lower case here.
"""

# -- fixed values ----------------------------------------------------------
SERVICE_SALE_TYPES = ("annual maintenance", "service opportunity", "added protection")
SALES_APPOINTMENT_TYPES = ("new", "rehash", "reset", "radon crm pickup")
SET_APPOINTMENT_TYPES = ("new", "reset", "radon crm pickup")
SERVICE_VISIT_TYPES = ("wcc", "service opportunity", "sanidry return")
NON_SALES_SOURCES = ("annual maintenance", "service opportunity", "existing database", "service")
DISQUALIFYING_REASONS = (
    "bad or old data",
    "spam",
    "not the type of work we do",
    "out of area",
)
EXISTING_DATABASE = "existing database"
SERVICE_WORK = "service work"
SERVICE_CATEGORY = "service"
SALES_DEPARTMENT = "sales"
SERVICE_DEPARTMENT = "service dept."
SERVICE_JOB = "021 - service work"
STATUS_CANCELED = "canceled"
STATUS_ACTIVE = "active"
RATE_ROW_TYPE = "wbi_goal"
GOAL_ROW_TYPE = "goal"
UNASSIGNED = "Unassigned"
# --------------------------------------------------------------------------

"""Fixed values the results depend on."""

# Three-digit ZIP prefixes with 20,000 residents or fewer.
RESTRICTED_ZIP3 = (
    "036", "059", "063", "102", "203", "556", "692", "790", "821",
    "823", "830", "831", "878", "879", "884", "890", "893",
)

# Columns the published patient dimension must not carry.
FORBIDDEN_PATIENT_COLUMNS = (
    "first_name", "last_name", "maiden_name", "name_prefix", "name_suffix",
    "birth_date", "death_date", "birthplace",
    "street_address", "city", "county", "zip_code", "latitude", "longitude",
)

# Payer names with a financial class of their own.
PAYER_CLASSES = {
    "NO_INSURANCE": "self_pay",
    "Medicare": "medicare",
    "Medicaid": "medicaid",
    "Dual Eligible": "dual_eligible",
}
OTHER_PAYER_CLASS = "commercial"
PUBLIC_PAYER_CLASSES = ("medicare", "medicaid", "dual_eligible")

# Ages from this one up form a single protected category.
PROTECTED_AGE = 90

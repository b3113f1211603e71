"""Fixed values that results depend on.

FIXED VALUES — these must stay exactly as written for results to agree with
the published behaviour of the register pipeline (codes of the Belgian
company register and of the annual-accounts chart).
"""

# Sector (NACE) codes of the hotel sector, used by target selection and search.
HOTEL_NACE_CODES = ("55100", "55201", "55202", "55203", "55204", "55209", "55300", "55400", "55900")

# Legal forms excluded from target selection.
EXCLUDED_FORMS = ("110", "114", "116", "117", "301", "302", "303", "310", "320", "330", "340",
                  "350", "400", "411", "412", "413", "414", "415", "416", "417", "418", "419", "420")

# Legal forms for which no notarial deeds are fetched.
NO_DEED_FORMS = ("009", "017", "018", "025", "026", "027", "051", "052")

# Metadata keys of a filing.
PERIOD_END_KEY = "Accounting period end date"
MODEL_CODE_KEY = "Model code"

# The 19 amount codes read from a filing, in this order.
AMOUNT_CODES = ("70", "70/76A", "70/74", "60", "60/61", "60/64", "60/66A", "71", "9901", "9904",
                "54", "55", "54/58", "17", "43", "17/49", "10/15", "100", "1011")

# All pivot keys (2 metadata keys + 19 amounts).
PIVOT_KEYS = (PERIOD_END_KEY, MODEL_CODE_KEY) + AMOUNT_CODES

# NACE versions with their own label category; others use the default.
NACE_VERSIONS = ("2003", "2008", "2025")
NACE_DEFAULT_VERSION = "2008"
NACE_FALLBACK_ORDER = ("2008", "2025", "2003")

# Denomination type of the official name; address type of the registered office.
OFFICIAL_NAME_TYPE = "1"
REGISTERED_ADDRESS_TYPE = "REGO"

# Target selection defaults.
ACTIVE_STATUS = "AC"
LEGAL_PERSON_KIND = "2"
MAIN_CLASSIFICATION = "MAIN"
DEPOSITS_SINCE = "2021-01-01"

# Display texts of the screens.
DEFAULT_NAME = "Entreprise sans dénomination"
DEFAULT_ADDRESS = "Adresse non renseignée"
ACTIVE_LABEL = "Actif"
UNKNOWN_STATUS = "Inconnu"
DEFAULT_FORM = "Société"
NOT_AVAILABLE = "N/C"

# Null markers of the register import (pandas defaults plus blank).
DEFAULT_NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                       "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
                       "nan", "null")

# Progress-table defaults when a target is seeded.
STATE_PENDING = "pending"
STATE_IN_PROGRESS = "in_progress"
STATE_DONE = "done"

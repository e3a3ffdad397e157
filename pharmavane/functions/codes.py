"""Code lists and unit factors. All fixed values, given as data."""

from __future__ import annotations

# Age group codes.
AGE_GROUPS = {
    "1": "Neonate",
    "2": "Infant",
    "3": "Child",
    "4": "Adolescent",
    "5": "Adult",
    "6": "Elderly",
}

# Sex codes.
SEXES = {1: "Male", 2: "Female"}

# The seriousness code; any other code stays unknown.
SERIOUS = {1: True, 2: False}

# Recurrence after re-administration.
RECURRENCE = {1: "Yes", 2: "No", 3: "Unknown"}

# Reaction outcome codes.
OUTCOMES = {
    "1": "Recovered/resolved",
    "2": "Recovering/resolving",
    "3": "Not recovered/not resolved",
    "4": "Recovered/resolved with sequelae (consequent health issues)",
    "5": "Fatal",
    "6": "Unknown",
}

# Unit code -> (multiplier, divisor) giving years.
AGE_TO_YEARS = {
    800: (10, 1),
    801: (1, 1),
    802: (1, 12),
    803: (1, 52.143),
    804: (1, 365.25),
    805: (1, 8766),
}

# Unit code -> (multiplier, divisor) giving days.
DURATION_TO_DAYS = {
    "801": (365.25, 1),
    "802": (30.46, 1),
    "803": (7, 1),
    "804": (1, 1),
    "805": (1, 24),
    "806": (1, 1440),
}

# Unit code -> multiplier for the dose column. Kept for equal
# results; the published meaning of the codes is in DOSE_TO_MG_STANDARD.
DOSE_TO_MG = {"001": 1e-6, "002": 1e-3, "003": 1.0, "004": 1e3}

# The public E2B units: 001 kilogram, 002 gram, 003 milligram, 004 microgram.
DOSE_TO_MG_STANDARD = {"001": 1e6, "002": 1e3, "003": 1.0, "004": 1e-3}

# Administration route codes.
ROUTES = {
    "001": "Auricular (otic)",
    "002": "Buccal",
    "003": "Cutaneous",
    "004": "Dental",
    "005": "Endocervical",
    "006": "Endosinusial",
    "007": "Endotracheal",
    "008": "Epidural",
    "009": "Extra-amniotic",
    "010": "Hemodialysis",
    "011": "Intra corpus cavernosum",
    "012": "Intra-amniotic",
    "013": "Intra-arterial",
    "014": "Intra-articular",
    "015": "Intra-uterine",
    "016": "Intracardiac",
    "017": "Intracavernous",
    "018": "Intracerebral",
    "019": "Intracervical",
    "020": "Intracisternal",
    "021": "Intracorneal",
    "022": "Intracoronary",
    "023": "Intradermal",
    "024": "Intradiscal (intraspinal)",
    "025": "Intrahepatic",
    "026": "Intralesional",
    "027": "Intralymphatic",
    "028": "Intramedullar (bone marrow)",
    "029": "Intrameningeal",
    "030": "Intramuscular",
    "031": "Intraocular",
    "032": "Intrapericardial",
    "033": "Intraperitoneal",
    "034": "Intrapleural",
    "035": "Intrasynovial",
    "036": "Intratumor",
    "037": "Intrathecal",
    "038": "Intrathoracic",
    "039": "Intratracheal",
    "040": "Intravenous bolus",
    "041": "Intravenous drip",
    "042": "Intravenous (not otherwise specified)",
    "043": "Intravesical",
    "044": "Iontophoresis",
    "045": "Nasal",
    "046": "Occlusive dressing technique",
    "047": "Ophthalmic",
    "048": "Oral",
    "049": "Oropharingeal",
    "050": "Other",
    "051": "Parenteral",
    "052": "Periarticular",
    "053": "Perineural",
    "054": "Rectal",
    "055": "Respiratory (inhalation)",
    "056": "Retrobulbar",
    "057": "Sunconjunctival",
    "058": "Subcutaneous",
    "059": "Subdermal",
    "060": "Sublingual",
    "061": "Topical",
    "062": "Transdermal",
    "063": "Transmammary",
    "064": "Transplacental",
    "065": "Unknown",
    "066": "Urethral",
    "067": "Vaginal",
}

"""Word lists and tables. All are fixed values that results depend on."""

# Legal forms that are stripped from names.
LEGAL = [
    "inc", "incorporated", "llc", "ltd", "limited", "corp", "corporation", "co", "company", "llp", "pvt", "private", "gmbh", "sa", "sarl", "bv",
    "plc", "lp", "pc", "pllc", "holdings", "group", "services", "center", "enterprises", "associates", "consultants", "solutions", "international", "intl",
]

# Generic words that block no candidate on their own.
STOPWORDS = [
    "and", "the", "of", "in", "for", "on", "at", "to", "a", "an", "services", "service", "center", "centre", "solutions", "solution",
    "enterprises", "enterprise", "group", "holdings", "holding", "industries", "associates", "consultants", "consulting", "management", "international",
    "national", "global", "direct", "trade", "traders", "trading", "commercial", "company", "corp", "corporation", "inc", "incorporated", "llc", "ltd", "limited",
    "pvt", "private", "llp", "gmbh", "co", "dept", "division", "agency", "tech", "technologies", "technology", "systems", "system", "products", "production",
    "care", "health", "medical", "clinic", "hospital", "store", "shop", "mart",
]

# Long address words and their short forms.
ADDRESS = {
    "street": "st", "road": "rd", "avenue": "ave", "boulevard": "blvd", "drive": "dr", "lane": "ln", "court": "ct", "circle": "cir", "highway": "hwy",
    "parkway": "pkwy", "suite": "ste", "apartment": "apt", "building": "bldg", "floor": "fl", "room": "rm", "terrace": "ter", "place": "pl", "square": "sq",
    "north": "n", "south": "s", "east": "e", "west": "w", "northeast": "ne", "northwest": "nw", "southeast": "se", "southwest": "sw",
    "township": "twp", "post": "po", "box": "bx",
}

# The legal terms of match forensics.
FORENSIC_LEGAL = [
    "inc", "incorporated", "llc", "l.l.c.", "ltd", "limited", "corp", "corporation", "co", "company", "llp", "l.l.p.", "pvt", "private", "gmbh", "sa", "sarl", "bv",
    "plc", "lp", "pc", "pllc",
]

# Long and short forms that match forensics looks for.
FORENSIC_ADDRESS = [
    ("street", "st"), ("road", "rd"), ("avenue", "ave"), ("boulevard", "blvd"), ("highway", "hwy"), ("parkway", "pkwy"), ("suite", "ste"),
    ("apartment", "apt"), ("drive", "dr"), ("lane", "ln"), ("court", "ct"), ("circle", "cir"), ("floor", "fl"),
]

# States and their abbreviations.
STATES = {
    "alabama": "al", "alaska": "ak", "arizona": "az", "arkansas": "ar", "california": "ca", "colorado": "co", "connecticut": "ct", "delaware": "de", "florida": "fl",
    "georgia": "ga", "hawaii": "hi", "idaho": "id", "illinois": "il", "indiana": "in", "iowa": "ia", "kansas": "ks", "kentucky": "ky", "louisiana": "la", "maine": "me",
    "maryland": "md", "massachusetts": "ma", "michigan": "mi", "minnesota": "mn", "mississippi": "ms", "missouri": "mo", "montana": "mt", "nebraska": "ne", "nevada": "nv",
    "new hampshire": "nh", "new jersey": "nj", "new mexico": "nm", "new york": "ny", "north carolina": "nc", "north dakota": "nd", "ohio": "oh", "oklahoma": "ok",
    "oregon": "or", "pennsylvania": "pa", "rhode island": "ri", "south carolina": "sc", "south dakota": "sd", "tennessee": "tn", "texas": "tx", "utah": "ut",
    "vermont": "vt", "virginia": "va", "washington": "wa", "west virginia": "wv", "wisconsin": "wi", "wyoming": "wy", "tamil nadu": "tn", "maharashtra": "mh",
    "karnataka": "ka", "delhi": "dl", "gujarat": "gj", "uttar pradesh": "up", "telangana": "ts", "andhra pradesh": "ap", "kerala": "kl", "west bengal": "wb",
}

# Abbreviations of the rank-failure taxonomy.
ABBREVIATIONS = {
    "st": "street", "rd": "road", "ave": "avenue", "dr": "drive", "blvd": "boulevard", "fl": "floor", "ste": "suite", "apt": "apartment", "bldg": "building",
    "mfg": "manufacturing", "intl": "international", "natl": "national", "corp": "corporation", "assoc": "associates", "univ": "university", "ctr": "center",
    "tech": "technology", "mgmt": "management", "ind": "industries", "dist": "district", "hwy": "highway", "sq": "square",
}

# Spelling folds of Indic names, in order.
INDIC_FOLDS = [
    ("ee", "i"), ("oo", "u"), ("v", "w"), ("ph", "f"), ("sh", "s"), ("th", "t"), ("gunj", "ganj"), ("pore", "pur"), ("dh", "d"), ("kh", "k"), ("gh", "g"), ("bh", "b"),
]

# Shared tokens that explain a hard negative.
GENERIC_NAME_TOKENS = "services enterprises solutions group holdings industries trading commercial international global care tech".split()
STREET_TOKENS = "street road avenue drive lane building floor suite estate nagar market chowk plaza tower complex gidc phase".split()

# Weights of key types in the evidence score, and the alternate weights.
KEY_WEIGHTS = {"alpha": 1.25, "dom6": 1.15, "2tok": 1.05, "pfx8": 0.95, "pfx6": 0.80, "anum": 0.75, "tok": 0.50}
ALTERNATE_WEIGHTS = {"alpha": 1.20, "dom6": 1.10, "2tok": 1.00, "pfx8": 0.90, "pfx6": 0.75, "anum": 0.70, "tok": 0.50}

# Scripts by code-point range, in the order they are tried.
SCRIPTS = [
    ("Tamil", r"[஀-௿]"), ("Devanagari (Hindi/Marathi)", r"[ऀ-ॿ]"), ("Telugu", r"[ఀ-౿]"), ("Kannada", r"[ಀ-೿]"),
    ("Malayalam", r"[ഀ-ൿ]"), ("Bengali", r"[ঀ-৿]"), ("Arabic", r"[؀-ۿ]"), ("Cyrillic", r"[Ѐ-ӿ]"), ("CJK (Chinese/Japanese)", r"[一-鿿]"),
]
SHORT_SCRIPTS = [("Tamil", 0), ("Devanagari", 1), ("Telugu", 2), ("Kannada", 3), ("Bengali", 5), ("Arabic", 6)]
MISSING = ["nan", "null", "none", "<missing>", "n/a"]
FORENSIC_MISSING = ["nan", "null", "none", "<missing>"]
NO_COUNTRY = ["NAN", "NULL", "NONE", "<MISSING>"]

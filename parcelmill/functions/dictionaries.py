"""The ordered dictionaries of the extraction rules.

The order of the entries is part of the rules: the first entry wins a tie.
"""

# --- fixed values -----------------------------------------------------------------------------

# Words of page headers; a line with one of them is noise.
HEADER_WORDS = ["Rechnung", "Invoice", "UPS", "Kunden-Nr", "Rechnungsdatum", "Lieferant", "Dachser"]

# Month spelling -> month number.
MONTHS = {
    "jan": 1, "januar": 1,
    "feb": 2, "februar": 2,
    "mär": 3, "maerz": 3, "märz": 3, "mar": 3, "mrz": 3,
    "apr": 4, "april": 4,
    "mai": 5,
    "jun": 6, "juni": 6,
    "jul": 7, "juli": 7,
    "aug": 8, "august": 8,
    "sep": 9, "sept": 9, "september": 9,
    "okt": 10, "oktober": 10, "oct": 10,
    "nov": 11, "november": 11,
    "dez": 12, "dezember": 12, "dec": 12,
}

SERVICES = [
    "Express", "Express Saver", "Express Worldwide",
    "International Priority", "International Economy",
    "Standard", "Economy", "Premium", "Domestic", "Worldwide",
]

# Country spelling -> ISO alpha-2 code.
COUNTRY_ALIASES = {
    "deutschland": "DE", "germany": "DE",
    "schweiz": "CH", "switzerland": "CH",
    "china": "CN", "volksrepublik": "CN",
    "hongkong": "HK", "hong kong": "HK",
    "österreich": "AT", "austria": "AT",
    "italien": "IT", "italy": "IT",
    "polen": "PL", "poland": "PL",
    "frankreich": "FR", "france": "FR",
    "spanien": "ES", "spain": "ES",
    "usa": "US", "vereinigte staaten": "US",
}

# Cost description -> cost category.
COST_CATEGORIES = {
    "transport": "Freight", "dritte partei transport": "Freight",
    "benzinzuschlag": "Fuel", "diesel": "Fuel",
    "maut": "Toll", "toll": "Toll",
    "zoll": "Customs", "customs": "Customs", "verzollung": "Customs",
    "handling": "Handling",
    "lager": "Storage", "storage": "Storage",
    "versicherung": "Insurance", "insurance": "Insurance",
    "rabatt": "Discount", "discount": "Discount",
    "surcharge": "Surcharge", "gebühr": "Surcharge", "surge fee": "Surcharge",
}

# A line with one of these is no cost row (longer phrases that contain one are left out).
COST_SKIP_WORDS = [
    "gesamtkosten", "gesamtbetrag", "anzahl", "package", "rabatt (gesamt)", "rabattzusammenfassung",
]

# Words that announce a shipment number on the same line.
IDENTIFIER_KEYWORDS = [
    "paketnummer", "frachtbrief", "tracking", "waybill", "awb",
    "referenz", "sendung", "shipment", "consignment",
]

# Words that end an address.
ADDRESS_END_WORDS = [
    "Transport", "Zuschlag", "Package", "Anzahl", "Gebühr", "Rabatt", "Tarife", "Gesamt",
    "Service", "Beschreibung", "MWST", "Basic",
]

INLINE_CURRENCIES = ["CHF", "EUR", "USD", "GBP"]

# ISO 3166 short names that differ from the English display names of the Java runtime.
ISO_SHORT_NAMES = {
    "AG": "Antigua and Barbuda", "BA": "Bosnia and Herzegovina",
    "BL": "Saint Barthélemy", "BN": "Brunei Darussalam",
    "BO": "Bolivia, Plurinational State of", "BQ": "Bonaire, Sint Eustatius and Saba",
    "CC": "Cocos (Keeling) Islands", "CD": "Congo, The Democratic Republic of the", "CG": "Congo",
    "CI": "Côte d'Ivoire", "FK": "Falkland Islands (Malvinas)",
    "FM": "Micronesia, Federated States of",
    "GS": "South Georgia and the South Sandwich Islands", "HK": "Hong Kong",
    "HM": "Heard Island and McDonald Islands", "IR": "Iran, Islamic Republic of",
    "CV": "Cabo Verde", "KN": "Saint Kitts and Nevis", "KP": "Korea, Democratic People's Republic of",
    "KR": "Korea, Republic of", "LA": "Lao People's Democratic Republic", "LC": "Saint Lucia",
    "MD": "Moldova, Republic of", "MF": "Saint Martin (French part)", "MM": "Myanmar",
    "MO": "Macao", "PM": "Saint Pierre and Miquelon", "PN": "Pitcairn",
    "PS": "Palestine, State of", "RU": "Russian Federation",
    "SH": "Saint Helena, Ascension and Tristan da Cunha", "SJ": "Svalbard and Jan Mayen",
    "ST": "Sao Tome and Principe", "SX": "Sint Maarten (Dutch part)",
    "SY": "Syrian Arab Republic", "TC": "Turks and Caicos Islands", "TR": "Türkiye",
    "TT": "Trinidad and Tobago", "TW": "Taiwan, Province of China",
    "TZ": "Tanzania, United Republic of", "UM": "United States Minor Outlying Islands",
    "VA": "Holy See (Vatican City State)", "VC": "Saint Vincent and the Grenadines",
    "VE": "Venezuela, Bolivarian Republic of", "VG": "Virgin Islands, British",
    "VI": "Virgin Islands, U.S.", "VN": "Viet Nam", "WF": "Wallis and Futuna",
}

# ISO 3166: numeric codes, common and official names of the countries that trade most, alpha-2 code first.
NUMERIC_CODES = {
    "AE": "784", "AR": "032", "AT": "040", "AU": "036", "BE": "056", "BG": "100", "BR": "076", "CA": "124", "CH": "756",
    "CL": "152", "CN": "156", "CO": "170", "CY": "196", "CZ": "203", "DE": "276", "DK": "208", "EE": "233", "EG": "818",
    "ES": "724", "FI": "246", "FR": "250", "GB": "826", "GR": "300", "HK": "344", "HR": "191", "HU": "348", "ID": "360",
    "IE": "372", "IL": "376", "IN": "356", "IS": "352", "IT": "380", "JP": "392", "KR": "410", "LI": "438", "LT": "440",
    "LU": "442", "LV": "428", "MA": "504", "MT": "470", "MX": "484", "MY": "458", "NG": "566", "NL": "528", "NO": "578",
    "NZ": "554", "PE": "604", "PH": "608", "PK": "586", "PL": "616", "PT": "620", "RO": "642", "RS": "688", "RU": "643",
    "SA": "682", "SE": "752", "SG": "702", "SI": "705", "SK": "703", "TH": "764", "TN": "788", "TR": "792", "TW": "158",
    "UA": "804", "US": "840", "VN": "704", "ZA": "710",
}
COMMON_NAMES = {
    "BO": "Bolivia", "IR": "Iran", "KR": "South Korea", "LA": "Laos", "MD": "Moldova", "TW": "Taiwan", "TZ": "Tanzania",
    "VE": "Venezuela", "VN": "Vietnam",
}
OFFICIAL_NAMES = {
    "AT": "Republic of Austria", "BE": "Kingdom of Belgium", "BG": "Republic of Bulgaria", "BR": "Federative Republic of Brazil",
    "CH": "Swiss Confederation", "CN": "People's Republic of China", "CV": "Republic of Cabo Verde", "CZ": "Czech Republic",
    "DE": "Federal Republic of Germany", "DK": "Kingdom of Denmark", "EE": "Republic of Estonia", "ES": "Kingdom of Spain",
    "FI": "Republic of Finland", "FR": "French Republic", "GB": "United Kingdom of Great Britain and Northern Ireland",
    "GR": "Hellenic Republic", "HK": "Hong Kong Special Administrative Region of China", "HR": "Republic of Croatia",
    "IN": "Republic of India", "IS": "Republic of Iceland", "IT": "Italian Republic", "LT": "Republic of Lithuania",
    "LU": "Grand Duchy of Luxembourg", "LV": "Republic of Latvia", "NL": "Kingdom of the Netherlands", "NO": "Kingdom of Norway",
    "PL": "Republic of Poland", "PT": "Portuguese Republic", "SE": "Kingdom of Sweden", "SG": "Republic of Singapore",
    "SI": "Republic of Slovenia", "SK": "Slovak Republic", "TR": "Republic of Türkiye", "US": "United States of America",
    "VN": "Socialist Republic of Viet Nam", "ZA": "Republic of South Africa",
}

# --- end of fixed values ----------------------------------------------------------------------

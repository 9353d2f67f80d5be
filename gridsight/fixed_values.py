"""Fixed values.

Everything here must hold exactly these values for the results to be right: limits,
priorities, lookup tables, text patterns and the company registry.  Plain data, no logic.
"""

# --- accepted ranges -------------------------------------------------------
PUE_MIN, PUE_MAX = "1.0", "3.0"
RENEWABLE_MIN, RENEWABLE_MAX = 0, 100
WUE_MIN, WUE_MAX = 0, 10
CAPACITY_ABOVE, CAPACITY_MAX = 0, 500
RACKS_ABOVE, RACKS_MAX = 0, 50000
YEAR_MIN = 2000
MIN_ROWS, MIN_COMPANIES = 20, 15
HOURS_PER_YEAR = 8760

# --- source quality --------------------------------------------------------
PUE_TYPE_PRIORITY = {
    "TTM": 5,
    "operating": 4,
    "annual": 3,
    "measured": 2,
    "design": 1,
    "estimated": 0,
}
SOURCE_PRIORITY = {
    "sustainability_report": 10,
    "esg_report": 9,
    "specification": 8,
    "investor_presentation": 7,
    "press_release": 6,
    "announcement": 5,
    "interview": 4,
    "news_article": 3,
    "estimate": 2,
    "benchmark": 1,
}

# --- tiers and the PUE assumed for a tier when none was measured -----------
TIER_1 = "Tier 1 - Global Hyperscaler"
TIER_2 = "Tier 2 - Indian Operator"
TIER_3 = "Tier 3 - Global Colocation"
TIER_DEFAULT_PUE = {TIER_1: "1.15", TIER_2: "1.45", TIER_3: "1.35"}
FALLBACK_PUE = "1.50"
# --- emission factors (kg CO2 per kWh) -----------
EMISSION_FACTORS = {"India": "0.82", "US": "0.42", "EU": "0.30", "Global": "0.47", "Singapore": "0.41"}
# --- places ----------------------------------------------------------------
# city: (country, region, mean yearly temperature in Celsius); None = not known
CITIES = {
    "Mumbai": ("India", "India - West", "27.2"),
    "Navi Mumbai": ("India", "India - West", "27.2"),
    "Pune": ("India", "India - West", "25.0"),
    "Nashik": ("India", "India - West", "24.5"),
    "Hyderabad": ("India", "India - South", "26.1"),
    "Chennai": ("India", "India - South", "28.6"),
    "Bangalore": ("India", "India - South", "23.6"),
    "Noida": ("India", "India - North", "25.3"),
    "Greater Noida": ("India", "India - North", "25.3"),
    "Gurugram": ("India", None, None),
    "Amaravati": ("India", "India - South", "27.8"),
    "Kolkata": ("India", None, None),
    "Ahmedabad": ("India", None, None),
    "Virginia": ("United States", "North America - East", "14.6"),
    "Oregon": ("United States", "North America - West", "11.4"),
    "California": ("United States", None, None),
    "Texas": ("United States", None, None),
    "New York": ("United States", None, None),
    "Frankfurt": ("Germany", "Europe - Central", "10.6"),
    "Belgium": ("Belgium", "Europe - West", "10.5"),
    "London": ("United Kingdom", "Europe - West", "11.0"),
    "Dublin": ("Ireland", "Europe - West", "9.8"),
    "Amsterdam": ("Netherlands", "Europe - West", "10.2"),
    "Singapore": ("Singapore", "Asia Pacific", "27.0"),
    "Tokyo": ("Japan", "Asia Pacific", "15.4"),
    "Hong Kong": ("Hong Kong", None, None),
}
CITY_ALIASES = {
    "Bombay": "Mumbai",
    "Noida/Greater Noida": "Noida",
    "Gurgaon": "Gurugram",
    "Bengaluru": "Bangalore",
    "Madras": "Chennai",
}
COUNTRY_CODES = {
    "India": "IN",
    "United States": "US",
    "Singapore": "SG",
    "Germany": "DE",
    "Belgium": "BE",
    "United Kingdom": "GB",
    "Ireland": "IE",
    "Netherlands": "NL",
    "Japan": "JP",
    "Hong Kong": "HK",
}
# fixed values: other names of countries that texts use
COUNTRY_ALIASES = {
    "UK": "GB",
    "Great Britain": "GB",
    "England": "GB",
    "Scotland": "GB",
    "Wales": "GB",
    "America": "US",
    "U.S.": "US",
    "U.S.A.": "US",
    "United States of America": "US",
    "UAE": "AE",
    "Holland": "NL",
    "Korea": "KR",
    "Republic of Korea": "KR",
    "Russian Federation": "RU",
    "Czech Republic": "CZ",
    "Viet Nam": "VN",
    "Ivory Coast": "CI",
    "Burma": "MM",
    "Macau": "MO",
    "Turkey": "TR",
}
# looked for in a text in this order; the first that occurs wins
TEXT_CITIES = [
    ("mumbai", "Mumbai", "India"),
    ("navi mumbai", "Navi Mumbai", "India"),
    ("pune", "Pune", "India"),
    ("nashik", "Nashik", "India"),
    ("hyderabad", "Hyderabad", "India"),
    ("chennai", "Chennai", "India"),
    ("bangalore", "Bangalore", "India"),
    ("bengaluru", "Bengaluru", "India"),
    ("noida", "Noida", "India"),
    ("greater noida", "Greater Noida", "India"),
    ("amaravati", "Amaravati", "India"),
    ("singapore", "Singapore", "Singapore"),
    ("virginia", "Virginia", "United States"),
    ("oregon", "Oregon", "United States"),
    ("frankfurt", "Frankfurt", "Germany"),
    ("london", "London", "United Kingdom"),
    ("dublin", "Dublin", "Ireland"),
    ("tokyo", "Tokyo", "Japan"),
]

# --- text patterns (all are matched without regard to case) ----------------
PUE_PATTERNS = [
    r"PUE\s*(?:of|is|:)?\s*(\d+\.\d+)",
    r"Power Usage Effectiveness\s*(?:of|is|:)?\s*(\d+\.\d+)",
    r"(?:rolling|annual|trailing)\s+(?:twelve[- ]month|TTM|12[- ]month)?\s*PUE\s*(?:of|is|:)?\s*(\d+\.\d+)",
    r"(?:rolling|annual)\s+(?:average\s+)?PUE\s*(?:of|is|reached)?\s*(\d+\.\d+)",
    r"design\s+PUE\s*(?:of|is|:)?\s*(\d+\.\d+)",
    r"designed\s+(?:with\s+)?(?:a\s+)?PUE\s*(?:of|:)?\s*(\d+\.\d+)",
    r"operating\s+PUE\s*(?:of|is|:)?\s*(\d+\.\d+)",
    r"operational\s+PUE\s*(?:of|is|:)?\s*(\d+\.\d+)",
    r"fleet[- ]wide\s+PUE\s*(?:of|is|:)?\s*(\d+\.\d+)",
    r"global\s+PUE\s*(?:of|is|:)?\s*(\d+\.\d+)",
    r"achieved\s+(?:a\s+)?PUE\s*(?:of|:)?\s*(\d+\.\d+)",
    r"maintains?\s+(?:a\s+)?PUE\s*(?:of|:)?\s*(\d+\.\d+)",
    r"average\s+PUE\s*(?:of|is|:)?\s*(\d+\.\d+)",
    r"(?:in|for)\s+(\d{4}).*?PUE\s*(?:of|is|was|:)?\s*(\d+\.\d+)",
    r"PUE\s*(?:of|is|was|:)?\s*(\d+\.\d+).*?(?:in|for)\s+(\d{4})",
]
PUE_TYPE_PATTERNS = [
    ("TTM", r"(?:rolling|trailing|TTM|twelve[- ]month|12[- ]month)"),
    ("operating", r"(?:operating|operational|actual)"),
    ("design", r"(?:design|designed|target)"),
    ("annual", r"(?:annual|yearly)"),
]
DEFAULT_PUE_TYPE = "operating"
CONTEXT_CHARS = 50
WUE_PATTERNS = [
    r"WUE\s*(?:of|is|:)?\s*(\d+\.?\d*)",
    r"Water Usage Effectiveness\s*(?:of|is|:)?\s*(\d+\.?\d*)",
    r"(\d+\.?\d*)\s*(?:liters?|L)\s+per\s+kWh",
    r"WUE.*?(\d+\.?\d*)\s*L/kWh",
    r"water\s+consumption.*?(\d+\.?\d*)\s*(?:liters?|L)\s*per\s*kWh",
]
FULL_RENEWABLE_PATTERNS = [
    r"100%\s+renewable\s+energy",
    r"fully\s+renewable",
    r"powered\s+by\s+100%\s+renewable",
]
RENEWABLE_PATTERNS = [
    r"(\d+)%\s+renewable",
    r"renewable.*?(\d+)%",
    r"(\d+)%\s+(?:clean|carbon[- ]free)\s+energy",
    r"matched\s+(\d+)%.*?renewable",
    r"(\d+)%.*?matched.*?renewable",
    r"(\d+)%\s+carbon[- ]free",
    r"carbon[- ]free.*?(\d+)%",
]
CAPACITY_PATTERNS = [
    r"(\d+\.?\d*)\s*MW\s+(?:capacity|power)",
    r"capacity\s*(?:of|:)?\s*(\d+\.?\d*)\s*MW",
    r"(\d+\.?\d*)\s*megawatts?",
    r"(\d+\.?\d*)\s*MW\s+(?:data\s+center|facility)",
]
RACK_PATTERNS = [
    r"(\d+(?:,\d+)?)\s+racks?",
    r"(\d+(?:,\d+)?)\s+server\s+racks?",
    r"rack\s+capacity.*?(\d+(?:,\d+)?)",
]
YEAR_PATTERNS = [r"\b(20[12]\d)\b", r"(?:in|for|during)\s+(20[12]\d)"]
LOCATION_PATTERNS = [
    r"(?:located\s+in|facility\s+in|data\s+center\s+in)\s+([A-Z][a-z]+(?:\s+[A-Z][a-z]+)*)",
    r"([A-Z][a-z]+),\s*([A-Z][a-z]+)",
]
# ours, off by default: two phrasings the lists above do not cover
EXTENDED_PUE_PATTERNS = [
    r"(?:rolling|trailing)\s+(?:twelve|12)[- ]month\s+PUE\s+reached\s+(\d+\.\d+)",
]
EXTENDED_CAPACITY_PATTERNS = [r"capacity\s+is\s+(\d+\.?\d*)\s*MW"]

SECTION_KEYWORDS = [
    "PUE",
    "Power Usage Effectiveness",
    "WUE",
    "Water Usage Effectiveness",
    "renewable energy",
    "carbon free",
    "data center efficiency",
    "sustainability",
    "megawatt",
    "MW",
    "capacity",
]

# --- search phrases --------------------------------------------------------
SEARCH_TEMPLATES = {
    "pue": "{company} PUE power usage effectiveness",
    "design_pue": "{company} design PUE data center",
    "operating_pue": "{company} operating PUE efficiency",
    "renewable": "{company} renewable energy percentage data center",
    "capacity": "{company} MW capacity racks data center",
    "sustainability": "{company} sustainability report ESG",
}
PUE_SEARCHES = [
    "{company} PUE power usage effectiveness",
    "{company} data center efficiency PUE",
    "{company} sustainability report PUE",
]
REPORT_SEARCHES = [
    "{company} sustainability ESG report",
    "{company} renewable energy data center",
    "{company} environmental report",
]

# --- company registry: name, tier, home region, pages ----------------------
COMPANIES = [
    ("Google", TIER_1, "Global", ["https://sustainability.google/reports/", "https://www.google.com/about/datacenters/efficiency/"]),
    ("AWS", TIER_1, "Global", ["https://sustainability.aboutamazon.com/environment/sustainable-operations/carbon-free-energy", "https://aws.amazon.com/about-aws/sustainability/"]),
    ("Microsoft", TIER_1, "Global", ["https://www.microsoft.com/en-us/corporate-responsibility/sustainability/report", "https://query.prod.cms.rt.microsoft.com/cms/api/am/binary/RE4RwfV"]),
    ("Meta", TIER_1, "Global", ["https://sustainability.fb.com/", "https://sustainability.fb.com/data-centers/"]),
    ("Equinix", TIER_1, "Global", ["https://www.equinix.com/about/sustainability", "https://sustainability.equinix.com/"]),
    ("Digital Realty", TIER_1, "Global", ["https://www.digitalrealty.com/sustainability", "https://sustainability.digitalrealty.com/"]),
    ("Yotta Infrastructure", TIER_2, "India", ["https://yotta.com/sustainability/", "https://yotta.com/data-centers/"]),
    ("CtrlS Datacenters", TIER_2, "India", ["https://www.ctrlsdatacenters.com/sustainability", "https://www.ctrlsdatacenters.com/"]),
    ("AdaniConneX", TIER_2, "India", ["https://www.adaniconnex.com/sustainability", "https://www.adaniconnex.com/data-centers"]),
    ("Nxtra by Airtel", TIER_2, "India", ["https://nxtra.in/sustainability/", "https://nxtra.in/data-centres/"]),
    ("ST Telemedia GDC India", TIER_2, "India", ["https://www.sttelemediagdc.in/sustainability", "https://www.sttelemediagdc.in/"]),
    ("NTT Global Data Centers India", TIER_2, "India", ["https://www.global.ntt/en/services/data-centers", "https://in.global.ntt/"]),
    ("Sify Technologies", TIER_2, "India", ["https://www.sifytechnologies.com/data-centers/", "https://www.sifytechnologies.com/sustainability/"]),
    ("Web Werks", TIER_2, "India", ["https://www.webwerks.in/", "https://www.webwerks.in/data-center-infrastructure"]),
    ("Pi DATACENTERS", TIER_2, "India", ["https://www.pidatacenters.com/", "https://www.pidatacenters.com/sustainability"]),
    ("ESDS", TIER_2, "India", ["https://www.esds.co.in/", "https://www.esds.co.in/data-center/"]),
    ("GPX Global", TIER_2, "India", ["https://www.gpxglobal.net/", "https://www.gpxglobal.net/data-centers/india"]),
    ("Colt DCS India", TIER_2, "India", ["https://www.colt.net/data-centre-services/", "https://www.colt.net/resources/sustainability/"]),
    ("NTT DATA Global", TIER_3, "Global", ["https://www.global.ntt/en/services/data-centers", "https://services.global.ntt/en-us/why-us/sustainability"]),
    ("CyrusOne", TIER_3, "Global", ["https://cyrusone.com/about/sustainability/", "https://cyrusone.com/data-centers/"]),
    ("QTS Realty Trust", TIER_3, "Global", ["https://www.qtsdatacenters.com/sustainability", "https://www.qtsdatacenters.com/"]),
    ("Vantage Data Centers", TIER_3, "Global", ["https://vantage-dc.com/sustainability/", "https://vantage-dc.com/data-centers/"]),
    ("Aligned Data Centers", TIER_3, "Global", ["https://www.alignedenergy.com/sustainability", "https://www.alignedenergy.com/"]),
    ("Iron Mountain", TIER_3, "Global", ["https://www.ironmountain.com/about-us/sustainability", "https://www.ironmountain.com/data-centers"]),
]
# company, facility, city, capacity MW, racks, design PUE, source type
KNOWN_FACILITIES = [
    ("Yotta Infrastructure", "Yotta NM1", "Navi Mumbai", 50, 7200, "1.40", "specification"),
    ("Yotta Infrastructure", "Yotta D1", "Greater Noida", 30, 4500, "1.38", "specification"),
    ("CtrlS Datacenters", "CtrlS Mumbai DC1", "Mumbai", 30, 3000, "1.45", "press_release"),
    ("CtrlS Datacenters", "CtrlS Hyderabad DC1", "Hyderabad", 45, 4200, "1.42", "press_release"),
    ("AdaniConneX", "AdaniConneX Chennai DC1", "Chennai", 60, 5000, "1.40", "announcement"),
    ("Nxtra by Airtel", "Nxtra Pune DC", "Pune", 20, 2500, "1.48", "specification"),
    ("ST Telemedia GDC India", "STT GDC Mumbai DC1", "Mumbai", 25, 3200, "1.43", "specification"),
    ("NTT Global Data Centers India", "NTT Mumbai DC6", "Mumbai", 18, 2000, "1.50", "specification"),
    ("Sify Technologies", "Sify Rabale DC", "Navi Mumbai", 12, 1500, "1.52", "specification"),
    ("Web Werks", "Web Werks DC1", "Mumbai", 8, 800, "1.55", "specification"),
    ("Pi DATACENTERS", "Pi Amaravati DC", "Amaravati", 15, 1800, "1.47", "specification"),
    ("ESDS", "ESDS Nashik DC", "Nashik", 5, 600, "1.60", "specification"),
    ("GPX Global", "GPX Mumbai DC", "Mumbai", 10, 1200, "1.50", "specification"),
    ("Colt DCS India", "Colt Mumbai DC", "Mumbai", 7, 900, "1.53", "specification"),
]

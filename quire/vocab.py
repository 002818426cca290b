"""Names, codes and ranges the catalogue is defined by.

Everything in this module is data whose exact value matters for the results.
Larger tables (the country list) are inputs, read by ``quire.sources.geography``.
"""

GLOBAL = "Global/Comparative"

# Journal abbreviation -> ISSN.
JOURNALS = {
    "APSR": "0003-0554",
    "AJPS": "0092-5853",
    "JOP": "0022-3816",
    "CPS": "0010-4140",
    "WP": "0043-8871",
    "SAPD": "0898-588X",
    "AER": "0002-8282",
    "QJE": "0033-5533",
    "JPE": "0022-3808",
    "Econometrica": "0012-9682",
    "RES": "0034-6527",
    "JEH": "0022-0507",
    "EEH": "0014-4983",
    "EHR": "0013-0117",
    "JHPE": "2693-9290",
}

# UN M.49 sub-regions, plus the catch-all for comparative work.
REGIONS = [
    "Northern Africa", "Eastern Africa", "Middle Africa", "Southern Africa", "Western Africa",
    "Northern America", "Caribbean", "Central America", "South America",
    "Central Asia", "Eastern Asia", "South-eastern Asia", "Southern Asia", "Western Asia",
    "Eastern Europe", "Northern Europe", "Southern Europe", "Western Europe",
    "Australia and New Zealand", "Melanesia", "Micronesia", "Polynesia",
    GLOBAL,
]

# The order continents are listed in.
CONTINENT_ORDER = ["Africa", "Americas", "Asia", "Europe", "Oceania"]

# Region spellings that stand for a valid sub-region.
REGION_ALIASES = {
    "Southern America": "South America",
    "North America": "Northern America",
}

# Country spellings -> catalogue name.
COUNTRY_ALIASES = {
    "Turkey": "Türkiye",
    "Russia": "Russian Federation",
    "South Korea": "Korea, Republic of",
    "North Korea": "Korea, Democratic People's Republic of",
    "Iran": "Iran, Islamic Republic of",
    "Syria": "Syrian Arab Republic",
    "Vietnam": "Viet Nam",
    "Ivory Coast": "Côte d'Ivoire",
    "Cape Verde": "Cabo Verde",
    "Swaziland": "Eswatini",
    "Macedonia": "North Macedonia",
    "Democratic Republic of the Congo": "Congo, The Democratic Republic of the",
    "DR Congo": "Congo, The Democratic Republic of the",
    "DRC": "Congo, The Democratic Republic of the",
    "São Tomé and Príncipe": "Sao Tome and Principe",
    "The Gambia": "Gambia",
    "England": "United Kingdom",
    "Scotland": "United Kingdom",
    "Wales": "United Kingdom",
    "Northern Ireland": "United Kingdom",
    "Vatican City": "Holy See (Vatican City State)",
    "Palestine": "Palestine, State of",
    "Taiwan": "Taiwan, Province of China",
}

# Official names found by case-insensitive look-up. Users extend this table.
OFFICIAL_NAMES = {
    "Czech Republic": "Czechia",
    "United States of America": "United States",
}

# Aliases that are parts of a country, not other spellings of it.
PARTS = ["England", "Scotland", "Wales", "Northern Ireland"]

# Catalogue name -> name shown to readers.
DISPLAY_NAMES = {
    "Congo, The Democratic Republic of the": "DR Congo",
    "Korea, Republic of": "South Korea",
    "Korea, Democratic People's Republic of": "North Korea",
    "Russian Federation": "Russia",
    "Iran, Islamic Republic of": "Iran",
    "Syrian Arab Republic": "Syria",
    "Viet Nam": "Vietnam",
    "Taiwan, Province of China": "Taiwan",
    "Palestine, State of": "Palestine",
    "Lao People's Democratic Republic": "Laos",
    "Bolivia, Plurinational State of": "Bolivia",
    "Venezuela, Bolivarian Republic of": "Venezuela",
    "Tanzania, United Republic of": "Tanzania",
    "Moldova, Republic of": "Moldova",
    "Holy See (Vatican City State)": "Vatican City",
}

# Period buckets as (label, first year, last year); None is open-ended.
BUCKETS = [
    ("Pre-1000", None, 999),
    ("1000–1499", 1000, 1499),
    ("1500–1599", 1500, 1599),
    ("1600–1699", 1600, 1699),
    ("1700–1799", 1700, 1799),
    ("1800–1849", 1800, 1849),
    ("1850–1899", 1850, 1899),
    ("1900–1944", 1900, 1944),
    ("1945+", 1945, None),
]

# Journal -> collection of the first repository (None = search all of it).
DATAVERSE_SUBTREE = {
    "APSR": "the_review",
    "AJPS": "ajps",
    "QJE": "qje",
    "JOP": None,
    "JPE": None,
    "CPS": "cps",
    "WP": "world-politics",
    "RES": "restat",
    "JHPE": "jhpe",
}

# Journal -> community of the second repository.
ZENODO_COMMUNITY = {"Econometrica": "es-replication-repository"}

# Journals whose publisher pages may carry the data, and that publisher's site.
PAGE_JOURNALS = ["Econometrica"]
PAGE_SITE = "econometricsociety.org"

# Journals reachable through reference lists only.
REFERENCE_ONLY_JOURNALS = ["AER", "JEH", "EEH", "EHR", "SAPD"]

# Patterns of a link to an archive, and of repository DOIs in reference text.
ARCHIVE_LINK = r"""(?i)href=["'][^"']*\.zip["']"""
REPOSITORY_DOI = r"(?iU)10\.7910/DVN/[A-Z0-9]+|10\.3886/[EI]\S+|10\.5281/zenodo\.\d+"

# Words that keep a title out of the published catalogue.
EXCLUDED_TITLE_WORDS = ["corrigendum", "erratum", "errata", "retraction", "retracted"]

# Placeholder texts and labels.
NO_ABSTRACT = "[No abstract; classify from title only]"
NO_RESPONSE = "_No response_"
MISSING_JOURNAL = "Unpublished"
MANUAL_BACKEND = "manual"
MANUAL_MODEL = "override"
REPLY_TOKENS = 512
COUNTRY_THRESHOLD = 25
CHUNK_SIZE = 500
ROW_BUDGET = 10
HEAT_EXPONENT = 0.55

# Golden cases as (doi, label, expected flag).
GOLDEN_CASES = [
    ("10.1257/aer.20200885", "Merchant Towns — Blaydes & Paik (2022)", True),
    ("10.1093/qje/qjy011", "Protestant Reformation — Cantoni et al. (2018)", True),
    ("10.3982/ecta11484", "Great Reform Act — Aidt & Franck (2015)", True),
    ("10.1093/qje/qjt005", "Women and the Plough — Alesina et al. (2013)", True),
    ("10.1093/qje/qjy024", "The Mission — Valencia (2019)", True),
    ("10.1093/qje/qjae023", "Jim Crow — Shertzer et al. (2024)", True),
    ("10.1017/s0003055420000180", "Democracy by Mistake — Treisman (2020)", False),
    ("10.1257/aer.104.9.2872", "Emissions Pass-through — Fabra & Reguant (2014)", False),
    ("10.1093/qje/qjaa023", "Randomizing Religion — Clingingsmith et al. (2020)", False),
    ("10.1257/aer.103.1.80", "School Admissions — Pathak & Sonmez (2013)", False),
    ("10.1257/aer.103.4.1463", "Monetary Transmission — Lenel (2013)", False),
]

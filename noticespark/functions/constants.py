"""Fixed values that must equal the behaviour being reproduced.

FIXED VALUES — stated plainly, in natural order, so results match.
Regexes use the portability rules of the survey: Python ``\\w`` becomes
``[\\p{L}\\p{N}_]`` and Python ``\\s`` / ``str.split()`` whitespace becomes an
explicit class; ``\\d`` stays ASCII digits (accepted deviation for non-ASCII
digits).
"""

# --- character classes (Java regex syntax, also valid in RE2 where used) ---
WORD = r"[\p{L}\p{N}_]"
WS_CHARS = r"\t-\r\x1c-\x20\x85\p{Z}"
WS = "[" + WS_CHARS + "]"
WS_RUN = "[" + WS_CHARS + "&&[^ ]]" + WS + "*| " + WS + "+"   # a whitespace run other than one plain space

# Kept ASCII characters with single spaces between words: nothing to normalise.
NORMAL_TEXT = r"\A(?:[A-Za-z0-9_\-.,;:()\[\]/]++(?: [A-Za-z0-9_\-.,;:()\[\]/]++)*+)?\z"

# --- HTS code patterns ---
# The lookbehind stands after the first digit, so only digits pay for it.
HTS_DOTTED10 = r"[0-9](?<![\p{L}\p{N}_][0-9])[0-9]{3}\.[0-9]{2}\.[0-9]{4}(?![\p{L}\p{N}_])"
HTS_DOTTED6 = r"[0-9](?<![\p{L}\p{N}_][0-9])[0-9]{3}\.[0-9]{2}(?![\p{L}\p{N}_])"
HTS_BARE10 = r"[0-9](?<![\p{L}\p{N}_][0-9])[0-9]{9}(?![\p{L}\p{N}_])"
HTS_VALID_FORMAT = r"^[0-9]{4}\.[0-9]{2}\.[0-9]{4}\n?\z"

# --- rate patterns, in pattern order ---
# What follows a number or blanks is neither, so they are never given back, and a number is tried from its first digit only.
_RATE_NUMBER = r"([0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++)?+)"
RATE_PATTERNS = [
    _RATE_NUMBER + WS + r"*+%",
    r"\$([0-9]++(?:\.[0-9]++)?+)" + WS + r"*+per",
    _RATE_NUMBER + WS + r"*+cents?" + WS + r"*+per",
]
RATE_SIGNS = ["%", "$", "cent"]   # what every match of the pattern holds
RATE_CONTEXT_CHARS = 100

# --- rate validation (anchored, case-insensitive for specific and cents) ---
RATE_AD_VALOREM = r"^([0-9]+(?:\.[0-9]+)?)" + WS + r"*%$"
RATE_SPECIFIC = r"(?i)^\$?([0-9]+(?:\.[0-9]+)?)" + WS + r"*(?:per|/)"
RATE_CENTS = r"(?i)^([0-9]+(?:\.[0-9]+)?)" + WS + r"*cents?" + WS + r"*(?:per|/)"

# --- dates ---
# Python formats %Y-%m-%d, %m/%d/%Y, %B %d, %Y, %b %d, %Y, %Y%m%d as Spark patterns
DATE_FORMATS = ["yyyy-M-d", "M/d/yyyy", "MMMM d, yyyy", "MMM d, yyyy", "yyyyMMdd"]
EFFECTIVE_DATE_HTML = [
    r"(?i)effective" + WS + r"+(?:date|on)?" + WS + r"*:?" + WS + r"*(" + WORD + "+" + WS + r"+[0-9]{1,2},?" + WS + r"+[0-9]{4})",
    r"(?i)shall" + WS + r"+(?:take" + WS + r"+effect|be" + WS + r"+effective)" + WS + r"+(?:on" + WS + r"+)?(" + WORD + "+" + WS + r"+[0-9]{1,2},?" + WS + r"+[0-9]{4})",
]
EFFECTIVE_DATE_CBP = [
    r"(?i)effective" + WS + r"+(?:date" + WS + r"+)?(?:is" + WS + r"+)?(" + WORD + "+" + WS + r"+[0-9]{1,2},?" + WS + r"+[0-9]{4})",
    r"(?i)effective" + WS + r"+([0-9]{1,2}/[0-9]{1,2}/[0-9]{4})",
]
DATE_WINDOW_DAYS = 30

# --- CSMS number ---
CSMS_NUMBER = r"(?i)CSMS" + WS + r"*#?([0-9]+)"

# --- source keyword filters ---
FR_SEARCH_TERMS = ["tariff", "duties", "import", "section 301", "section 232", "trade remedy", "safeguard"]
FR_RESULTS_PER_TERM = 100
USTR_KEYWORDS = ["tariff", "section 301", "section 232", "trade", "duties", "import", "exclusion", "annex"]
CBP_KEYWORDS = ["tariff", "section 301", "section 232", "duties", "hts", "entry", "import",
                "trade remedy", "antidumping", "countervailing"]
LISTING_LINK_LIMIT = 20
PDFS_PER_PAGE = 2
USTR_BASE_URL = "https://ustr.gov"
CBP_BASE_URL = "https://www.cbp.gov"

# --- countries ---
COUNTRY_NAME_TO_ISO2 = {
    "CHINA": "CN", "RUSSIA": "RU", "CANADA": "CA", "MEXICO": "MX",
    "JAPAN": "JP", "KOREA": "KR", "GERMANY": "DE", "FRANCE": "FR",
    "UNITED KINGDOM": "GB", "ITALY": "IT", "INDIA": "IN", "BRAZIL": "BR",
}
COMMON_COUNTRY_CODES = ["CN", "US", "CA", "MX", "JP", "KR", "DE", "GB", "FR", "IT", "RU", "IN", "BR"]

# --- HTS chapters ---
CHAPTER_DESCRIPTIONS = {
    1: "Live animals",
    72: "Iron and steel",
    73: "Articles of iron or steel",
    84: "Machinery and mechanical appliances",
    85: "Electrical machinery and equipment",
    87: "Vehicles",
}

# --- sources ---
SOURCE_PRIORITIES = {"federal_register": 1, "cbp_csms": 2, "ustr": 3}
PARSER_VERSION = "1.0.0"
SOURCE_PAIR_RELATIONSHIP = [
    ("federal_register", "ustr", "policy_context"),
    ("ustr", "federal_register", "legal_authority"),
    ("federal_register", "cbp_csms", "implementation"),
    ("cbp_csms", "federal_register", "implements"),
    ("ustr", "cbp_csms", "operational_guidance"),
    ("cbp_csms", "ustr", "implements_policy"),
]
DEFAULT_RELATIONSHIP = "related"

# --- confidence weights (added in this order) ---
W_REQUIRED, W_HTS, W_DATE, W_RATE, W_QUALITY = 0.25, 0.25, 0.15, 0.15, 0.20
REQUIRED_FIELDS = ["source", "document_type", "title", "publication_date", "source_url"]
QUALITY_LABELS = [(0.9, "excellent"), (0.75, "good"), (0.6, "fair"), (0.4, "poor")]
QUALITY_LABEL_ELSE = "very_poor"

# --- link / duplicate scoring ---
LINK_W_DOCNUM, LINK_W_HTS, LINK_W_TITLE, LINK_W_DATE = 0.4, 0.3, 0.2, 0.1
LINK_TITLE_THRESHOLD = 0.7
LINK_MIN_CONFIDENCE = 0.5
LINK_CANDIDATE_LIMIT = 5
DUPLICATE_THRESHOLD = 0.85
VALIDATION_STATUSES = ["verified", "pending", "failed", "manual_review"]

# The declared validation rules (rule, severity, kind, path, argument, path and value of the condition).
RULES = [
    ("hts_code_pattern", "error", "pattern", "tariff_action.products.hts_code", HTS_VALID_FORMAT, "", ""),
    ("hts_code_length", "error", "length", "tariff_action.products.hts_code", "13", "", ""),
    ("effective_date >= publication_date", "error", "not_before", "effective_date", "publication_date", "", ""),
    ("expiration_date > effective_date", "warning", "after", "expiration_date", "effective_date", "", ""),
    ("rate_types", "error", "one_of", "tariff_action.rate_type", "ad_valorem|specific|compound", "", ""),
    ("rate_ad_valorem_pattern", "error", "pattern", "tariff_action.rate_original", r"^\d+(\.\d+)?%$", "tariff_action.rate_type", "ad_valorem"),
    ("rate_specific_pattern", "error", "pattern", "tariff_action.rate_original", r"^\$\d+(\.\d+)?\s*(per|/)", "tariff_action.rate_type", "specific"),
    ("required:source", "error", "required", "source", "", "", ""),
    ("required:document_type", "error", "required", "document_type", "", "", ""),
    ("required:title", "error", "required", "title", "", "", ""),
    ("required:publication_date", "error", "required", "publication_date", "", "", ""),
    ("required:tariff_action.type", "error", "required", "tariff_action.type", "", "", ""),
    ("required:source_url", "error", "required", "source_url", "", "", ""),
    ("confidence:excellent", "info", "band", "confidence_raw", "0.9,", "", ""),
    ("confidence:good", "info", "band", "confidence_raw", "0.75,0.9", "", ""),
    ("confidence:fair", "info", "band", "confidence_raw", "0.6,0.75", "", ""),
    ("confidence:poor", "info", "band", "confidence_raw", "0.4,0.6", "", ""),
    ("confidence:very_poor", "info", "band", "confidence_raw", ",0.4", "", ""),
]

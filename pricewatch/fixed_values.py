"""Word lists, patterns, rates and thresholds that results depend on.

Patterns are Java regular expressions. ``(?iU)`` makes case folding, ``\\s`` and
``\\b`` Unicode-aware, which the multilingual titles need.
"""

# --- Fixed values: output columns -------------------------------------------------

PRICE_LOG_COLUMNS = (
    "obs_date",
    "obs_time",
    "brand",
    "product_name",
    "country",
    "platform",
    "price",
    "currency",
    "provenance",
    "status",
    "trend",
)

PRICE_LOG_CSV_HEADER = {
    "obs_date": "Date",
    "obs_time": "Time",
    "brand": "Brand",
    "product_name": "Product Name",
    "country": "Country",
    "platform": "Platform",
    "price": "Price",
    "currency": "Currency",
    "provenance": "Page Title",
    "status": "Status",
    "trend": "Price_Trend",
}

CATALOG_COLUMNS = (
    "brand_raw",
    "raw_text",
    "url",
    "size_hint_inch",
    "price_hint_eur",
    "price_local",
    "currency",
    "price_eur",
    "platform",
    "country",
    "scraped_at",
    "asin",
    "elkjop_sku",
    "model_year",
    "filter_year",
    "source_brand",
    "fx_rate_date",
)

# --- Fixed values: series key, statuses, provenance, trends ------------------------

SERIES_KEY = ("product_name", "country", "platform")
ACTIVE_WORDS = ("true", "1", "yes")
DEFAULT_COUNTRY = "FR"

STATUS_OK = "Success"
STATUS_UNSUPPORTED = "Skipped: Unsupported Platform"
STATUS_DEAD = "Failed: Dead Link"
STATUS_NAVIGATION = "Failed: Navigation Error"
STATUS_NO_PRICE = "Failed: Price Not Found"

FROM_BATCH = "Batch category snapshot"
FROM_API = "Direct API"

TREND_LABELS = {"NEW": "新上线", "DOWN": "降价", "UP": "涨价", "FLAT": "持平"}
NO_TREND = "-"

# --- Fixed values: retention, guard, gates, bounds ---------------------------------

KEEP_DAYS = 45

GUARD_MIN_SAMPLE = 20
GUARD_MEDIAN = (0.75, 1.35)
GUARD_EXTREME = (0.4, 2.5)
GUARD_EXTREME_SHARE = 0.05

CANARY_BAND = (0.5, 1.5)
SEARCH_CANARY_RANGE = (50, 10000)
MIN_SCHEMA_PRICE = 10

SNAPSHOT_LOOKBACK = 7
VARIANT_SEED_BUDGET = 40
SEEDS_PER_FAMILY = 2
VARIANTS_PER_SEED = 10
SERIES_RESCUE_BUDGET = 25
RECOVERY_BUDGET = 40
LISTING_PAGE_SIZE = 48
MIN_HITS_PER_YEAR = 100
MIN_CARD_TITLE = 8

# --- Fixed values: exchange rates (units per EUR) ----------------------------------

FX_RATE_DATE = "2026-07-01"
UNITS_PER_EUR = {"EUR": "1", "NOK": "11.3125", "GBP": "0.85973"}

# --- Fixed values: markets and canary anchors --------------------------------------

MARKETS = (
    # code, currency, search word, location required
    ("DE", "EUR", "fernseher", True),
    ("GB", "GBP", "tv", True),
    ("IT", "EUR", "televisore", False),
    ("ES", "EUR", "televisor", False),
)

MARKET_SITES = {
    "DE": "https://www.amazon.de",
    "GB": "https://www.amazon.co.uk",
    "IT": "https://www.amazon.it",
    "ES": "https://www.amazon.es",
}

CANARIES = (
    # market, asin, known price
    ("DE", "B0GYZMPVXG", 229.99),
    ("DE", "B0GT9QKMRM", 169.99),
    ("GB", "B0F7WHLF6M", 149.0),
    ("GB", "B0F9PP6BKT", 138.0),
    ("IT", "B0GM1HFTNL", 159.0),
    ("IT", "B0F54B34TH", 159.0),
    ("ES", "B0GJFWX36Y", 154.9),
    ("ES", "B0F9PVTQL2", 149.0),
)

CATALOG_MARKETS = (
    # registry key, platform, country
    ("boulanger", "Boulanger", "FR"),
    ("currys", "Currys", "GB"),
    ("amazon_de", "Amazon", "DE"),
    ("amazon_gb", "Amazon", "GB"),
    ("amazon_it", "Amazon", "IT"),
    ("amazon_es", "Amazon", "ES"),
    ("elkjop", "Elkjop", "NO"),
)

# --- Fixed values: brands and years ------------------------------------------------

TARGET_BRANDS = ("SAMSUNG", "LG", "TCL", "HISENSE", "SONY")
TARGET_YEARS = (2025, 2026)
FACET_BRANDS = ("Hisense", "LG", "iFfalcon", "Samsung", "Sony", "TCL")
REQUIRED_SOURCE_BRANDS = ("hisense", "lg", "samsung", "sony", "tcl")

AMAZON_BRANDS = (
    "Samsung", "Hisense", "Sony", "TCL", "LG", "Philips", "Panasonic", "Toshiba", "Xiaomi",
)
BOULANGER_BRANDS = (
    "Samsung", "Hisense", "Sony", "TCL", "LG", "Philips", "Panasonic", "Grundig", "Thomson",
    "Sharp", "Blaupunkt",
)
CURRYS_BRANDS = (
    "Samsung", "Hisense", "Sony", "TCL", "LG", "Philips", "Panasonic", "Toshiba", "JVC",
    "Sharp", "Blaupunkt", "Hitachi", "Amazon",
)
ELKJOP_BRANDS = ("Samsung", "LG", "Sony", "TCL", "Hisense")

# --- Fixed values: facet query -----------------------------------------------------

FACET_TAXONOMY = "PT351"
YEAR_ATTRIBUTE = "33627"
SIZE_ATTRIBUTE = "31323"

# --- Fixed values: price text ------------------------------------------------------

CURRENCY_TOKENS = ("€", "£", "$", "EUR", "GBP", "USD", "NOK", "nok", "KR", "kr", "\xa0")
RE_KRONER = r"(?iU)(?:^|\s)kr(?:\s|$)"
RE_NUMBER = r"\d+(?:\.\d+)?"
RE_FLOAT = r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?$"

# --- Fixed values: product identity ------------------------------------------------

RE_BOULANGER_REF = r"(?i)/ref/(\d+)"
RE_CURRYS_ID = r"(?i)(\d{7,9})(?:\.html)?(?:[?#]|$)"
RE_ELKJOP_SKU = r"/(\d{5,9})(?:[/?#]|$)"
RE_CURRYS_SLUG = r"/products/([^/?#]+)"
RE_ASIN = r"(?i)^[A-Z0-9]{10}$"
RE_ASIN_IN_URL = r"(?i)/dp/([A-Z0-9]{10})"
SITE_ROOT = {
    "boulanger": "https://www.boulanger.com",
    "currys": "https://www.currys.co.uk",
    "elkjop": "https://www.elkjop.no",
}

# --- Fixed values: size, year, range -----------------------------------------------

RE_SIZE_AMAZON = r"(?iU)(\d{2,3})\s*(?:[- ]?\s*(?:Zoll|inch(?:es)?|pollici|pulgadas)|[\"'”″])"
RE_SIZE_POUCES = r"(?iU)(\d{2,3})\s*pouces?\b"
RE_SIZE_QUOTE = r"(?U)(\d{2,3})\s*[\"'']"
RE_SIZE_CM = r"(?iU)(\d{2,3})\s*cm\b"
RE_SIZE_CURRYS = r"(?iU)(\d{2,3})\s*(?:[\"”″'']|-?\s*inch)"
RE_SIZE_ELKJOP = r"(?iU)(?<!\d)(\d{2,3})\s*(?:[\"”″]|tommer|inch)"
RE_YEAR = r"(?U)\b(2025|2026)\b"
RE_RANGE = r"(?iU)(\d+)\s*[–-]\s*(\d+)\s+av\s+(\d+)\s+produkter"

# --- Fixed values: accessory titles ------------------------------------------------

RE_NON_TV = (
    r"(?iU)projektor|projector|projecteur|proiettore|proyector|laser\s*tv|beamer"
    r"|\bstanbyme\b|\bmonitor\b|moniteur"
    r"|business\s*display|professional\s*display|signage"
    r"|displayschutz|bildschirmschutz|schutzfolie|displayfolie|screen\s*protector|panzerglas"
    r"|wandhalterung|wall\s*mount|tv[- ]?halterung|supporto|soporte"
    r"|fußständer|tv[- ]?ständer|tv[- ]?stand|tv[- ]?beine|netzteil|fernbedienung"
    r"|mounting\s+screws?|vesa\s+screws?|ladegerät|power\s*(?:supply|adapter)|tv\s+power\s+adapter"
)
RE_REMOTE_ACCESSORY = (
    r"(?iU)\breplace(?:ment)?\s+remote\b"
    r"|\bremote\s+(?:suit(?:able)?\s+for|compatible\s+with|for)\b"
    r"|\buniversal\s+(?:tv\s+)?remote(?:\s+control)?\b"
    r"|\btelecomando\s+(?:sostitutivo|di\s+ricambio|compatibile)\b"
    r"|\bmando\s+(?:de\s+reemplazo|sustituto|compatible)\b"
)

# --- Fixed values: variants and series ---------------------------------------------

RE_VARIANT_HINT = r"(?iU)\b(?:Options?|Optionen|Opzioni|Opciones)\s*:\s*\d+"
RE_CURRENT_SERIES = (
    r"(?iU)(?:S9[05]H|S8[05]H|QN\d{2,4}H|QN\d{2,4}F|Q\dF|Q\dFA|U\d{4}F"
    r"|C\d[KL]|P\d[KL]|X11L|QNED\d{2}[AB]|OLED\d{2}[A-Z0-9]*[56]?[A-Z]*)"
)
RE_EXPLICIT_2026 = r"(?U)\b2026\b"

SERIES_PATTERNS = {
    "SAMSUNG": (
        r"(?iU)(?:GQ|GU|QE|TQ|TU)?\d{2,3}(S(?:85|90|95|99)[FH])",
        r"(?iU)(?:GQ|QE|TQ)?\d{2,3}(QN(?:70|80|85|90|900|990)[FH])",
        r"(?iU)\b(S(?:85|90|95|99)[FH]|QN(?:70|80|85|90|900|990)[FH])\b",
        r"(?iU)\b(Q[678]F|LS03(?:FW|H)|M[78]0H|R\d{2}H|U\d{4}F)\b",
    ),
    "LG": (
        r"(?iU)OLED\s*\d{2,3}\s*([BCG][56])",
        r"(?iU)(?:^|\D)\d{2,3}(QNED\d{2}[AB]|UA\d{2}|NU\d{2})",
        r"(?iU)\b(QNED\d{2}[AB]|UA\d{2}|NU\d{2})\b",
        r"(?iU)\b([BCG][56])\b",
    ),
    "TCL": (
        r"(?iU)(?:^|\D)\d{2,3}(X11L|C\d[KL](?:\s*PRO|S)?|P\d[KL]|Q\dC|T6C|S[45][KL]?|A\d{3}(?:U|W|\s*PRO)?)\b",
        r"(?iU)\b(X11L|C\d[KL](?:\s*PRO|S)?|P\d[KL]|Q\dC|T6C|S[45][KL]?|A\d{3}(?:U|W|\s*PRO)?)\b",
    ),
    "HISENSE": (
        r"(?iU)(?:^|\D)\d{2,3}(A[4567][QS]|E[678][QS](?:\s*PRO)?|U[789][QS](?:\s*(?:PRO|E))?|UR[89]S|S5Q)\b",
        r"(?iU)\b(A[4567][QS]|E[678][QS](?:\s*PRO)?|U[789][QS](?:\s*(?:PRO|E))?|UR[89]S|S5Q)\b",
    ),
    "SONY": (
        r"(?iU)\b(BRAVIA\s*[23589](?:\s*II)?)\b",
        r"(?iU)\b(XR\d{2}(?:M2)?)\b",
    ),
}

CURRENT_SUFFIXES = {"SAMSUNG": ("H",), "TCL": ("L",), "LG": ("6", "B"), "HISENSE": ("S",)}

# --- Fixed values: listing titles --------------------------------------------------

SPEC_PREFIXES = (
    "fréquence", "frequence", "résolution", "resolution", "consommation",
    "rétroéclair", "retroeclair", "balayage", "luminosité", "luminosite", "native",
)
RE_MODEL_LIKE = r"[A-Z]\d|\d[A-Z]"
RE_RATING = r"^\d[,.]\d/5\s*\("

# --- Fixed values: dead and blocked pages ------------------------------------------

DEAD_MARKERS = ("404", "page not found", "not found")
DEAD_MARKERS_BY_CHANNEL = {
    "boulanger": ("oups", "épuisé", "epuise"),
    "currys": ("no longer available", "out of stock", "can't find", "cannot find"),
    "amazon": (
        "nicht verfügbar", "nicht verfugbar", "derzeit nicht", "ausverkauft",
        "currently unavailable", "out of stock", "seite nicht gefunden",
    ),
    "elkjop": ("siden finnes ikke",),
}
GONE_STATUSES = (404, 410)

BLOCKED_TITLE_MARKERS = (
    "bear with us",
    "just a moment",
    "ein moment",
    "access denied",
    "attention required",
    "cloudflare",
    "security checkpoint",
)
BLOCKED_CONTENT_MARKERS = ("checking your connection", "verify you are human")

# --- Fixed values: run-log lines ---------------------------------------------------

RE_LOG_TIMESTAMP = r"(20\d{2}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d+)?Z)"
RE_LOG_PRODUCT = r"→ \[([A-Z]{2})\] (.+?) \((Boulanger|Currys)\)"
RE_LOG_BATCH = r"(?U)\[ok/batch\]\s+([A-Z]{3})\s+(\d+(?:\.\d+)?)\s+\(([^)]+)\)"
RE_LOG_PAGE = r"(?U)\[ok\]\s+[A-Z]{3}\s+\d+(?:\.\d+)?\s+\([^)]+\)"
RECOVERY_PLATFORMS = ("Boulanger", "Currys")
RECOVERY_METHOD = "github_action_log_exact_batch_pair"
EXCLUDED_REASON = "并发 PDP 成功日志未重复输出商品名，无法可靠归属"

# --- Fixed values: whitespace ------------------------------------------------------

WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

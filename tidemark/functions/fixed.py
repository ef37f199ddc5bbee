"""Fixed values that results depend on: names, codes, keywords, ids and formats."""

from __future__ import annotations

# Currency name -> ISO code, 28 fixed entries.
ISO_CODES = [
    ("Dólar de N.A.", "USD"),
    ("Dólar Estadounidense", "USD"),
    ("Dólar Australiano", "AUD"),
    ("Dólar Canadiense", "CAD"),
    ("Dólar de Hong Kong", "HKD"),
    ("Dólar de Singapur", "SGD"),
    ("Dólar Neozelandés", "NZD"),
    ("Dólar de N.Z.", "NZD"),
    ("Peso Chileno", "CLP"),
    ("Peso Colombiano", "COP"),
    ("Peso Mexicano", "MXN"),
    ("Peso Argentino", "ARS"),
    ("Real Brasileño", "BRL"),
    ("Real Brasilero", "BRL"),
    ("Libra Esterlina", "GBP"),
    ("Yen Japonés", "JPY"),
    ("Yuan Chino", "CNY"),
    ("Renminbi", "CNY"),
    ("Won Coreano", "KRW"),
    ("Franco Suizo", "CHF"),
    ("Euro", "EUR"),
    ("Corona Sueca", "SEK"),
    ("Corona Noruega", "NOK"),
    ("Corona Danesa", "DKK"),
    ("Corona Checa", "CZK"),
    ("Zloty Polaco", "PLN"),
    ("Sol Peruano", "PEN"),
    ("Nuevo Sol", "PEN"),
]
UNKNOWN_ISO = "???"
USD_ALIAS = "Dólar de N.A."
USD_NAME = "Dólar Estadounidense"

# Selectable series code -> currency name.
SERIES_CODES = [
    ("02", "Dólar de N.A."),
    ("11", "Dólar canadiense"),
    ("34", "Libra Esterlina"),
    ("38", "Yen japonés"),
    ("55", "Corona sueca"),
    ("57", "Franco suizo"),
    ("66", "Euro"),
]

# Cell texts that mean "no value".
AMOUNT_MISSING = ["", "-", "S/M"]
RATE_MISSING = ["", "-", "--", "NA", "N/A"]

# National holidays on fixed (month, day); two more move with Easter (3 and 2 days before).
FIXED_HOLIDAYS = [
    (1, 1), (5, 1), (6, 7), (6, 29), (7, 23), (7, 28), (7, 29),
    (8, 6), (8, 30), (10, 8), (11, 1), (12, 8), (12, 9), (12, 25),
]
EASTER_HOLIDAY_OFFSETS = [3, 2]

# Deposit-rate measures, in output order.
BANK = "Banco"
MEASURES = [
    "Depósitos de Ahorro",
    "Hasta 30 días",
    "31-90 días",
    "91-180 días",
    "181-360 días",
    "Más de 360 días",
    "Depósitos a Plazo",
    "Depósitos CTS",
]
TERM_BUCKETS = MEASURES[1:6]

# Measure -> keywords looked for inside the lower-cased column name.
MEASURE_KEYWORDS = {
    "Depósitos de Ahorro": ["ahorro", "depósitos de ahorro", "depositos de ahorro"],
    "Hasta 30 días": ["hasta 30", "hasta 30 días", "0-30"],
    "31-90 días": ["31-90", "31 - 90"],
    "91-180 días": ["91-180", "91 - 180"],
    "181-360 días": ["181-360", "181 - 360"],
    "Más de 360 días": ["más de 360", "mas de 360"],
    "Depósitos CTS": ["cts", "depósitos cts", "depositos cts"],
}
# Measure -> whole names that match it (so that its own sub-columns do not).
MEASURE_EXACT = {"Depósitos a Plazo": ["depósitos a plazo", "depositos a plazo"]}

BUCKET_PATTERN = "(?iu)(Hasta.*|31-90.*|91-180.*|181-360.*|Más de.*)"
NATURAL_PATTERN = "(?i)Natur"
LEGAL_PATTERN = "(?i)Jur"
ENTITY_HEADER_WORDS = ["empresa", "entidad", "sistema"]

NATIONAL = "Moneda Nacional"
FOREIGN = "Moneda Extranjera"
NATURAL = "Natural"
LEGAL = "Jurídica"

# Page ids of the deposit tables.
NATIONAL_IDS = [
    "ctl00_cphContent_rpgActualPrimTablaMn_OT",
    "ctl00_cphContent_rpgActualPrimTablaMn_ctl00_DataZone_DT",
    "ctl00_cphContent_rpgActualMn_OT",
    "ctl00_cphContent_rpgActualMn_ctl00_DataZone_DT",
]
FOREIGN_IDS = [
    "ctl00_cphContent_rpgActualPrimTablaMex_OT",
    "ctl00_cphContent_rpgActualPrimTablaMex_ctl00_DataZone_DT",
    "ctl00_cphContent_rpgActualMex_OT",
    "ctl00_cphContent_rpgActualMex_ctl00_DataZone_DT",
]
# Page table id -> (logical table, currency type, by person?).
LOGICAL_TABLES = [
    ("ctl00_cphContent_rpgActualPrimTablaMn_OT", "nacional_general", NATIONAL, False),
    ("ctl00_cphContent_rpgActualMn_OT", "nacional_persona", NATIONAL, True),
    ("ctl00_cphContent_rpgActualPrimTablaMex_OT", "extranjera_general", FOREIGN, False),
    ("ctl00_cphContent_rpgActualMex_OT", "extranjera_persona", FOREIGN, True),
]
ROW_LABEL_CLASS = "rpgRowHeaderField"

# Average-rate grid.
GRID_ID = "ctl00_cphContent_rgTipoCambio"
GRID_CLASS = "rgMasterTable"
GRID_ROW_CLASSES = ["rgRow", "rgAltRow"]
GRID_COLUMNS = ("MONEDA", "COMPRA (S/)", "VENTA (S/)")

# Page gates.
MIN_PAYLOAD_BYTES = 400
PAYLOAD_MARK = "FECHA"
LABEL_ID = "ctl00_cphContent_lblMensajeFecha"
BLOCK_MARK = '<iframe id="main-iframe"'
FOREIGN_MARK = "Extranjera"

# Days looked back for a seed: range variant / day-by-day variant.
RANGE_LOOKBACK_DAYS = 46
WEEKDAY_LOOKBACK_DAYS = 45

# MIME type -> file extension.
MIME_EXTENSIONS = [
    ("text/html", ".html"),
    ("text/css", ".css"),
    ("application/javascript", ".js"),
    ("text/javascript", ".js"),
    ("application/json", ".json"),
    ("application/manifest+json", ".webmanifest"),
    ("image/png", ".png"),
    ("image/jpeg", ".jpg"),
    ("image/webp", ".webp"),
    ("image/gif", ".gif"),
    ("image/svg+xml", ".svg"),
    ("font/woff2", ".woff2"),
    ("font/woff", ".woff"),
    ("application/font-woff", ".woff"),
    ("application/octet-stream", ""),
]

# References that never point at a capturable resource.
SKIPPED_SCHEMES = ["#", "mailto:", "tel:", "javascript:", "data:", "blob:", "about:"]

IDLE_GAP_SECONDS = 2.0
IDLE_CAP_SECONDS = 60.0

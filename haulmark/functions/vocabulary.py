"""Fixed values of the market: labels, categories and routing words, as arguments for the operators."""

from __future__ import annotations

# Country names as published, and their display names. One table serves every view.
COUNTRY_LABELS = {
    "뉴질랜드": "New Zealand",
    "중국": "China",
    "홍콩": "Hong Kong",
    "러시아 연방": "Russia",
    "러시아": "Russia",
    "카자흐스탄": "Kazakhstan",
    "호주": "Australia",
    "미국": "United States",
    "아르헨티나": "Argentina",
    "몽골": "Mongolia",
    "싱가포르": "Singapore",
}

# Destinations and origins shown by name; all others are "Other".
NAMED_DESTINATIONS = ["China", "Korea", "Hong Kong"]
NAMED_ORIGINS = ["New Zealand", "China", "Russia", "Hong Kong", "Kazakhstan", "Australia"]

# Article categories with their display names; the last one is the default.
CATEGORY_LABELS = {
    "규제정책": "Regulatory policy",
    "무역시장": "Trade market",
    "건강제품": "Health products",
    "수입유통": "Import & distribution",
    "업계소식": "Industry news",
    "기타": "Other",
}
DEFAULT_CATEGORY = "기타"

# Notes that tell the product form of a quarantine row, in order, and the form without any.
QUARANTINE_FORM_RULES = [(["생녹용"], "frozen"), (["녹용"], "dried")]
QUARANTINE_DEFAULT_FORM = "dried"

# Words that route a question, in order of the handlers.
QUESTION_ROUTES = [
    (["nz", "뉴질랜드", "export", "수출", "new zealand", "stats nz", "trade", "거래"], "trade_flow"),
    (["import", "수입", "mfds", "record", "기록", "food", "식품", "importer", "수입업체"], "import_records"),
    (["news", "뉴스", "article", "기사", "latest", "최신", "naver", "네이버", "press", "언론"], "news_summary"),
]

# Yearly import totals and the 2024 split by country, in thousands of US dollars.
YEARLY_TOTALS = {
    2004: 18751,
    2005: 17531,
    2006: 17806,
    2007: 21476,
    2008: 14962,
    2009: 14146,
    2010: 16786,
    2011: 17516,
    2012: 18044,
    2013: 19835,
    2014: 26377,
    2015: 31094,
    2016: 29001,
    2017: 28944,
    2018: 30078,
    2019: 32244,
    2020: 31184,
    2021: 34242,
    2022: 39364,
    2023: 24178,
    2024: 28026,
}
YEARLY_BY_COUNTRY = {
    (2024, "New Zealand"): 18515,
    (2024, "Russia"): 9442,
    (2024, "Kazakhstan"): 69,
}

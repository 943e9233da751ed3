"""Fixed values of the news domain: journals, sections, hosts and word lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The journals.
JOURNALS = [
    "baodautu",
    "dantri",
    "diendandoanhnghiep",
    "phapluatdoisong",
    "laodong",
    "nhipcaudautu",
    "vietnamnet",
    "vneconomy",
    "vtc",
    "saigontimes",
]

# Journal, section URL, article type.
SECTIONS = [
    ("diendandoanhnghiep", "https://en.diendandoanhnghiep.vn/business-economics", "economy"),
    ("diendandoanhnghiep", "https://en.diendandoanhnghiep.vn/investment", "investment"),
    ("diendandoanhnghiep", "https://en.diendandoanhnghiep.vn/vcci", "fintech"),
    ("nhipcaudautu", "https://e.nhipcaudautu.vn/economy", "economy"),
    ("nhipcaudautu", "https://e.nhipcaudautu.vn/tech", "fintech"),
    ("nhipcaudautu", "https://e.nhipcaudautu.vn/market", "market"),
    ("nhipcaudautu", "https://e.nhipcaudautu.vn/companies", "finance"),
    ("nhipcaudautu", "https://e.nhipcaudautu.vn/real-estate", "real-estate"),
    ("vneconomy", "https://en.vneconomy.vn/investment.htm", "investment"),
    ("vneconomy", "https://en.vneconomy.vn/green-economy.htm", "fintech"),
    ("vneconomy", "https://en.vneconomy.vn/business.htm", "economy"),
    ("vneconomy", "https://en.vneconomy.vn/banking-finance.htm", "finance"),
    ("vneconomy", "https://en.vneconomy.vn/property.htm", "finance"),
    ("vneconomy", "https://en.vneconomy.vn/digital-biz.htm", "fintech"),
    ("vietnamnet", "https://vietnamnet.vn/en/business-news-tag1394942316563964544", "economy"),
    ("vietnamnet", "https://vietnamnet.vn/en/vietnams-stock-market-tag16543088519370150224", "market"),
    ("vietnamnet", "https://vietnamnet.vn/en/vietnams-real-estate-market-tag10713918583500998948", "real-estate"),
    ("vietnamnet", "https://vietnamnet.vn/en/vietnams-monetary-market-tag677031158975677480", "finance"),
    ("saigontimes", "https://english.thesaigontimes.vn/category/business/bizinfo", "economy"),
    ("saigontimes", "https://english.thesaigontimes.vn/category/business/financial-markets/", "market"),
    ("saigontimes", "https://english.thesaigontimes.vn/category/business/corporate/", "finance"),
    ("saigontimes", "https://english.thesaigontimes.vn/tag/stock-market/", "market"),
]

# Host put before a relative image address.
IMAGE_HOSTS = {
    "baodautu": "https://media.baodautu.vn/",
    "dantri": "https://icdn.dantri.com.vn",
    "phapluatdoisong": "https://media.doisongphapluat.com",
    "diendandoanhnghiep": "https://diendandoanhnghiep.vn",
    "vneconomy": "https://media.vneconomy.vn",
    "vietnamnet": "https://static-images.vnncdn.net",
    "nhipcaudautu": "https://imgst.nhipcaudautu.vn/",
    "vtc": "https://cdn-i.vtcnews.vn",
}

# Host put before an article link found on a listing page.
LINK_HOSTS = {
    "vneconomy": "https://vneconomy.vn",
    "nhipcaudautu": "https://nhipcaudautu.vn",
    "dantri": "https://dantri.com.vn",
    "vietnamnet": "https://vietnamnet.vn",
    "phapluatdoisong": "https://www.doisongphapluat.com",
    "vtc": "https://vtc.vn",
    "cafef": "https://cafef.vn",
    "cafebiz": "https://cafebiz.vn",
    "vietstock": "https://vietstock.vn",
}

# Mobile host removed from a link before the host above is put on.
MOBILE_HOSTS = {
    "cafef": "https://m.cafef.vn",
    "cafebiz": "https://m.cafebiz.vn",
}

# What follows the section URL on listing page {n}.
LISTING_SUFFIX = {
    "baodautu": "/p{n}",
    "vietnamnet": "-page{n}.html",
    "vneconomy": "?trang={n}",
    "saigontimes": "/page/{n}/",
    "diendandoanhnghiep": "/trang-{n}/",
    "nhipcaudautu": "/?paged={n}",
    "dantri": "/trang-{n}.htm",
    "phapluatdoisong": "/page/{n}",
    "vtc": "/trang-{n}.html",
    "laodong": "?page={n}",
}

# Domain stop words and phrases.
DOMAIN_STOP_WORDS = [
    "company", "companies", "stock", "stocks", "share", "shares", "market", "markets", "exchange",
    "exchanges", "price", "prices", "pricing", "trade", "trades", "trading", "financial", "finance",
    "finances", "fiscal", "monetary", "investor", "investors", "investment", "investments", "fund", "funds",
    "funding", "economy", "economic", "economies", "bank", "banks", "banking", "revenue", "revenues",
    "profit", "profits", "loss", "losses", "dividend", "dividends", "quarter", "quarterly", "annual",
    "annually", "report", "reports", "reported", "earning", "earnings", "forecast", "forecasts",
    "forecasting", "growth", "decline", "percentage", "percent", "rise", "rises", "rising", "fall", "falls",
    "falling", "increase", "increases", "increasing", "decrease", "decreases", "decreasing", "up", "down",
    "gain", "gains", "gaining", "drop", "drops", "dropping", "billion", "million", "trillion", "dollar",
    "dollars", "year", "years", "month", "months", "day", "days", "time", "period", "vietnamese business",
    "vietnamese enterprise", "vietnamese economy", "vietnamese market", "asean", "vietnamese exporter",
    "vietnamese export",
]

# General English stop words (public list), with the three extra words.
ENGLISH_STOP_WORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "you're", "you've", "you'll", "you'd",
    "your", "yours", "yourself", "yourselves", "he", "him", "his", "himself", "she", "she's", "her", "hers",
    "herself", "it", "it's", "its", "itself", "they", "them", "their", "theirs", "themselves", "what",
    "which", "who", "whom", "this", "that", "that'll", "these", "those", "am", "is", "are", "was", "were",
    "be", "been", "being", "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an", "the",
    "and", "but", "if", "or", "because", "as", "until", "while", "of", "at", "by", "for", "with", "about",
    "against", "between", "into", "through", "during", "before", "after", "above", "below", "to", "from",
    "up", "down", "in", "out", "on", "off", "over", "under", "again", "further", "then", "once", "here",
    "there", "when", "where", "why", "how", "all", "any", "both", "each", "few", "more", "most", "other",
    "some", "such", "no", "nor", "not", "only", "own", "same", "so", "than", "too", "very", "s", "t", "can",
    "will", "just", "don", "don't", "should", "should've", "now", "d", "ll", "m", "o", "re", "ve", "y", "ain",
    "aren", "aren't", "couldn", "couldn't", "didn", "didn't", "doesn", "doesn't", "hadn", "hadn't", "hasn",
    "hasn't", "haven", "haven't", "isn", "isn't", "ma", "mightn", "mightn't", "mustn", "mustn't", "needn",
    "needn't", "shan", "shan't", "shouldn", "shouldn't", "wasn", "wasn't", "weren", "weren't", "won", "won't",
    "wouldn", "wouldn't",
]
EXTRA_STOP_WORDS = ["from", "re", "also"]

STOP_WORDS = ENGLISH_STOP_WORDS + EXTRA_STOP_WORDS + DOMAIN_STOP_WORDS

# A small default lemma table; callers pass their own for real work.
DEFAULT_LEMMAS = {
    "are": "be", "is": "be", "was": "be", "were": "be", "been": "be", "am": "be",
    "has": "have", "had": "have", "does": "do", "did": "do", "done": "do",
    "men": "man", "women": "woman", "children": "child", "people": "people",
    "companies": "company", "economies": "economy", "markets": "market", "banks": "bank",
    "prices": "price", "shares": "share", "stocks": "stock", "rose": "rise", "rising": "rise",
    "fell": "fall", "falling": "fall", "grew": "grow", "growing": "grow", "said": "say",
    "better": "good", "best": "good", "worse": "bad", "worst": "bad",
}


def section_catalogue(spark: SparkSession) -> DataFrame:
    """(journal, section_url, type); a fixed dimension, so it may always be broadcast."""
    return spark.createDataFrame(SECTIONS, "journal string, section_url string, type string")

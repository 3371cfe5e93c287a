"""Dimensions: fixed values, as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Id, item, label, first and last year.
DYNASTIES = [
    ("qin", "Q7183", "秦", -221, -206), ("western-han", "Q1072949", "西漢", -206, 9), ("xin", "Q504769", "新", 9, 23), ("eastern-han", "Q1043", "東漢", 25, 220),
    ("han", "Q7209", "漢", -206, 220), ("three-kingdoms", "Q1143535", "三國", 220, 280), ("cao-wei", "Q1150555", "曹魏", 220, 266), ("shu-han", "Q742440", "蜀漢", 221, 263),
    ("eastern-wu", "Q742462", "東吳", 222, 280), ("jin-western", "Q83788", "西晉", 266, 316), ("jin-eastern", "Q83602", "東晉", 317, 420), ("northern-wei", "Q83806", "北魏", 386, 534),
    ("sui", "Q9685", "隋", 581, 618), ("tang", "Q9683", "唐", 618, 907), ("five-dynasties", "Q242115", "五代", 907, 960), ("northern-song", "Q8903", "北宋", 960, 1127),
    ("southern-song", "Q8908", "南宋", 1127, 1279), ("song", "Q1107", "宋", 960, 1279), ("yuan", "Q42497", "元", 1271, 1368), ("ming", "Q9903", "明", 1368, 1644),
    ("qing", "Q8733", "清", 1636, 1912), ("republic-of-china", "Q134261", "民國", 1912, 1949), ("prc", "Q148", "中华人民共和国", 1949, 2100),
]
#: countries' ids, items and labels; the item of the region, which is no dynasty.
COUNTRIES = [("japan", "Q17", "日本")]
CHINA = "Q29520"
PRIORITY = ["tang", "song", "yuan", "ming", "qing"]
PRE_MING_LAST, PRE_MING = 1367, ("明前", -221, 1367)
POST = ["Q9903", "Q8733", "Q134261", "Q148"]
#: Property, key, normalisation.
IDENTIFIERS = [("P214", "viaf", "digits"), ("P497", "cbdb", "no_zeros"), ("P1187", "dila", "trim"), ("P1188", "dila", "trim"), ("P349", "ndl", "trim"), ("P4711", "chgis", "trim"), ("P2477", "bdrc", "trim")]
#: Language pack, label languages in order, script.
LANGUAGES = {
    "zh-hant": (["zh-hant", "zh-tw"], "hant"), "zh-hans": (["zh-hans", "zh-cn"], "hans"), "lzh": (["lzh", "zh-hant"], "hant"), "ja": (["ja"], "ja"),
    "ko": (["ko"], "ko"), "en": (["en"], "latn"), "bo": (["bo"], "tibt"), "vi": (["vi"], "latn"),
}
#: kinds' included and excluded classes.
KINDS = {
    "person": (["Q5"], []),
    "place": (["Q618123", "Q2221906", "Q515", "Q532", "Q56061", "Q82794", "Q8502", "Q4022", "Q23442", "Q1248784", "Q28739697", "Q30234100", "Q486972", "Q7930989"], ["Q4167410", "Q13442814"]),
    "org": (["Q43229", "Q4830453", "Q2385804", "Q3918", "Q5341295", "Q2659904", "Q177634", "Q7315155", "Q15911314", "Q11016"], ["Q4167410", "Q13442814"]),
    "work": (
        ["Q7725634", "Q571", "Q47461344", "Q178385", "Q87167", "Q5185279", "Q1261499", "Q3331189"],
        ["Q4167410", "Q13442814", "Q17329259", "Q11424", "Q24869", "Q7889", "Q482994", "Q15416", "Q5398426", "Q21191270", "Q53933099", "Q134556", "Q639661", "Q873933", "Q1004", "Q7397", "Q185598"],
    ),
}
FICTIONAL = ["Q15632617", "Q28037560", "Q3658341"]
HUMAN, DISAMBIGUATION = "Q5", "Q4167410"
#: Dynasty labels of lists, with years and English names.
STATIC_LABELS = [
    ("秦", -221, -206, "Qin"), ("西漢", -206, 9, "Western Han"), ("西汉", -206, 9, "Western Han"), ("前漢", -206, 9, "Western Han"), ("東漢", 25, 220, "Eastern Han"),
    ("东汉", 25, 220, "Eastern Han"), ("漢", -206, 220, "Han"), ("汉", -206, 220, "Han"), ("魏", 220, 266, "Wei"), ("曹魏", 220, 266, "Cao Wei"), ("蜀", 221, 263, "Shu Han"),
    ("蜀汉", 221, 263, "Shu Han"), ("蜀漢", 221, 263, "Shu Han"), ("吳", 222, 280, "Eastern Wu"), ("吴", 222, 280, "Eastern Wu"), ("東吳", 222, 280, "Eastern Wu"),
    ("东吴", 222, 280, "Eastern Wu"), ("西晉", 266, 316, "Western Jin"), ("西晋", 266, 316, "Western Jin"), ("東晉", 317, 420, "Eastern Jin"), ("东晋", 317, 420, "Eastern Jin"),
    ("北魏", 386, 534, "Northern Wei"), ("隋", 581, 618, "Sui"), ("唐", 618, 907, "Tang"), ("五代", 907, 960, "Five Dynasties"), ("北宋", 960, 1127, "Northern Song"),
    ("南宋", 1127, 1279, "Southern Song"), ("宋", 960, 1279, "Song"), ("刘宋", 420, 479, "Liu Song"), ("劉宋", 420, 479, "Liu Song"), ("南齐", 479, 502, "Southern Qi"),
    ("南齊", 479, 502, "Southern Qi"), ("梁", 502, 557, "Liang"), ("陈", 557, 589, "Chen"), ("陳", 557, 589, "Chen"), ("元", 1271, 1368, "Yuan"), ("明", 1368, 1644, "Ming"),
    ("清", 1636, 1912, "Qing"), ("民国", 1912, 1949, "ROC"), ("民國", 1912, 1949, "ROC"), ("中华人民共和国", 1949, 2100, "PRC"),
]


def selected_dynasties(ids: list[str] | None = None, priority: bool = False) -> list[tuple]:
    """Dynasties by their ids, in that order, or those of priority; an unknown id, or none at all, is an error."""
    chosen = PRIORITY if priority else ids
    known = {d[0]: d for d in DYNASTIES}
    if not chosen or (unknown := [i for i in chosen if i not in known]):
        raise ValueError(f"unknown dynasties {unknown}" if chosen else "name dynasties, or those of priority")
    return [known[i] for i in chosen]


def selected_country(ident: str) -> tuple:
    """A country by its id; an unknown one is an error."""
    found = [c for c in COUNTRIES if c[0] == ident]
    if not found:
        raise ValueError(f"unknown country {ident}")
    return found[0]


def selection(membership: str, dynasties: list[str] | None = None, priority: bool = False, country: str | None = None) -> tuple[list[str], str]:
    """(items, name) of what a membership selects: dynasties, a country, or nothing for the memberships that need none."""
    if membership == "country-p27":
        found = [selected_country(country or "")]
    elif membership == "dynasty-p27":
        found = selected_dynasties(dynasties, priority)
    else:
        return [], membership
    return [f[1] for f in found], "priority" if priority and membership == "dynasty-p27" else "+".join(f[0] for f in found)


def dynasties(spark: SparkSession) -> DataFrame:
    rows = [(k, *d, d[0] in PRIORITY) for k, d in enumerate(DYNASTIES)]
    return spark.createDataFrame(rows, "ord int, id string, qid string, label string, start int, end int, priority boolean")


def static_labels(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(STATIC_LABELS, "label string, start int, end int, english string")

"""Small fixed dimensions of the statistics (fixed values)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CATEGORIES = ["自転車盗", "車上ねらい", "部品ねらい", "自動車盗", "オートバイ盗", "自動販売機ねらい", "ひったくり"]
CHARGES = ["窃盗"]
LAYERS = {"bicycle": ["自転車盗"], "vehicle": ["車上ねらい", "部品ねらい", "自動車盗", "オートバイ盗"]}
LAYER_NAMES = {"bicycle": "自転車", "vehicle": "車・バイク"}
BANDS = ["0-6", "6-12", "12-18", "18-24"]
BOXES = ["unresolved", "unobserved", "undecided", "gone"]
WINDOW_YEARS = 8
#: Further columns each category must have, and those any year may have.
EXTRA = {
    "自転車盗": ["被害者の年齢", "被害者の職業", "施錠関係"],
    "車上ねらい": ["施錠関係", "現金被害の有無"],
    "部品ねらい": ["現金以外の主な被害品"],
    "自動車盗": ["施錠関係", "盗難防止装置の有無", "現金以外の主な被害品"],
    "オートバイ盗": ["施錠関係", "盗難防止装置の有無", "現金以外の主な被害品"],
    "自動販売機ねらい": ["現金被害の有無"],
    "ひったくり": ["被害者の性別", "被害者の年齢", "現金被害の有無"],
}
OPTIONAL = ["発生場所", "発生場所の詳細", "発生場所の属性"]


def layers(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, c) for k, cs in LAYERS.items() for c in cs], "layer string, category string")


def categories(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(c,) for c in CATEGORIES], "category string")


def bands(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, b) for i, b in enumerate(BANDS)], "band_no int, band string")


def boxes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(b,) for b in BOXES], "box string")

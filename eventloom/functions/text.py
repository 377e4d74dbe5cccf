"""Text builders for search: one labelled line or one sentence per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Labels and separator of the indexed text, in output order.
EVENT_LABELS = (
    ("event_type", "事件类型: "),
    ("user_id", "用户: "),
    ("product_id", "商品: "),
    ("page", "页面: "),
    ("referrer", "来源: "),
    ("device", "设备: "),
    ("browser", "浏览器: "),
)
PRODUCT_LABELS = (
    ("product_id", "商品ID: "),
    ("total_views", "浏览次数: "),
    ("total_purchases", "购买次数: "),
    ("conversion_rate_pct", "转化率: "),
)
TEXT_SEPARATOR = "，"
MISSING_WORDS = ("None", "nan", "")


def _known(name: str, *also_missing: str) -> Column:
    """Text of a column, or null when it holds nothing worth printing."""
    text = F.col(name).cast("string")
    return F.when(~text.isin(*MISSING_WORDS, *also_missing), text)


def event_text(df: DataFrame, out: str = "text_content") -> DataFrame:
    """Labelled event line; absent parts and the fill-in defaults are left out."""
    value = {
        "event_type": F.coalesce(F.col("event_type"), F.lit("unknown")),
        "user_id": F.coalesce(F.col("user_id"), F.lit("unknown")),
        "product_id": _known("product_id", "unknown"),
        "page": _known("page"),
        "referrer": _known("referrer", "direct"),
        "device": _known("device"),
        "browser": _known("browser"),
    }
    parts = [F.concat(F.lit(label), value[name]) for name, label in EVENT_LABELS]
    return df.withColumn(out, F.concat_ws(TEXT_SEPARATOR, *parts))


def product_text(df: DataFrame, out: str = "text_content") -> DataFrame:
    """Labelled product line; zero counts and rates are left out."""
    nonzero = {c: F.when(F.col(c) != 0, F.col(c).cast("string")) for c, _ in PRODUCT_LABELS[1:]}
    value = {
        **nonzero,
        "product_id": F.coalesce(F.col("product_id"), F.lit("unknown")),
        "conversion_rate_pct": F.concat(nonzero["conversion_rate_pct"], F.lit("%")),
    }
    parts = [F.concat(F.lit(label), value[name]) for name, label in PRODUCT_LABELS]
    return df.withColumn(out, F.concat_ws(TEXT_SEPARATOR, *parts))


def event_sentence(df: DataFrame) -> Column:
    """English sentence about one event, built from the parts that are known."""
    category = _known("product_category") if "product_category" in df.columns else F.lit(None).cast("string")
    device, browser = _known("device"), _known("browser")
    gear = F.concat_ws(" ", F.lit("via"), device, browser)
    return F.concat_ws(
        " ",
        F.concat(
            F.lit("User "), F.coalesce(F.col("user_id"), F.lit("?")),
            F.lit(" performed "), F.coalesce(F.col("event_type"), F.lit("?")),
        ),
        F.concat(F.lit("on product "), _known("product_id", "unknown")),
        F.concat(F.lit("(category: "), category, F.lit(")")),
        F.concat(F.lit("from "), _known("referrer", "direct")),
        F.concat(F.lit("on page "), _known("page")),
        F.when(device.isNotNull() | browser.isNotNull(), gear),
        F.when(F.col("duration_ms") > 0, F.concat(F.lit("duration "), F.col("duration_ms").cast("string"), F.lit("ms"))),
    )


def event_chunks(df: DataFrame, lo: int = 20, hi: int = 200, out: str = "chunk") -> DataFrame:
    """The sentence of each event in chunks of at most ``hi`` characters, numbered by ``chunk_no`` from 0.

    A short sentence gains the event id in front. A long one is cut at word ends, so its chunks joined by blanks are
    the whole sentence; only a word longer than ``hi`` is cut itself.
    """
    sentence = event_sentence(df)
    named = F.concat(F.lit("Event "), F.coalesce(F.col("event_id"), F.lit("?")), F.lit(": "), sentence)
    whole = F.when(F.length(sentence) < lo, named).otherwise(sentence)
    parts = F.when(F.length(whole) <= hi, F.array(whole)).otherwise(
        F.regexp_extract_all(whole, F.lit(rf"(?s)\S.{{0,{hi - 1}}}(?!\S)|\S{{{hi}}}"), F.lit(0))
    )
    return df.select("*", F.posexplode(parts).alias("chunk_no", out))


def preview(text: Column, most: int = 200) -> Column:
    """For display only: a text longer than ``most`` characters ends in an ellipsis."""
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most - 3), F.lit("..."))).otherwise(text)

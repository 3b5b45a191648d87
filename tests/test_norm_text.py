"""The normalizer's pattern against the plain class of characters."""

import re

from pyspark.sql import functions as F

from corpuskb.functions import facts
from corpuskb.functions.text import norm_text


def test_every_character_is_kept_or_dropped_as_by_ranges(spark):
    codes = [k for k in [*range(1, 0x3000), *range(0xFE00, 0x10000), 0x10FFFF, 0x1F600] if not 0xD800 <= k < 0xE000]
    rows = spark.createDataFrame([(f"a{chr(k)}b", k) for k in codes], "t string, k long")
    lowered = F.replace(F.lower("t"), F.lit("ё"), F.lit("е"))
    ranges = F.trim(F.regexp_replace(F.regexp_replace(lowered, r"\([^)]*\)", " "), "[^0-9a-zа-я]+", " "))
    assert rows.where(norm_text(F.col("t")) != ranges).count() == 0
    # ranges of Latin letters and digits are judged one after the other for each character, which takes most of the time
    assert not re.search("0-9|a-z", str(norm_text(F.col("t"))))


def test_only_words_that_can_have_an_ending_are_searched_for_one(spark):
    words = ["house", "башнями", "дома", "дом", "мост1", "1ами", "thouанами", "", None, "а", "ъъъъъ"]
    pattern = r"\A(.{4,}?)(?:" + "|".join(dict.fromkeys(facts.STEM_ENDINGS)) + r")\Z"
    rows = spark.createDataFrame([(w,) for w in words], "w string")
    assert [r[0] for r in rows.select(facts.stem(F.col("w"))).collect()] == [w if w is None else re.sub(pattern, r"\1", w, flags=re.DOTALL) for w in words]
    assert "CASE WHEN" in str(facts.stem(F.col("w")))

"""Titles, names and keys: normal forms and matches as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Brackets, zero-width characters and the suffixes that sites add to titles.
ZERO_WIDTH = "[​‌‍﻿]"
BRACKETED = r"[（(【\[《][^）)】\]》]*[）)】\]》]"
BRACKETS = r"[（(【\[《）)】\]》]"
SITE_WORDS = "简谱|歌谱|五线谱|正谱|完整版|弹唱|吉他谱|钢琴谱|歌曲类"
SEPARATORS = r"[\s\-_·、,，。.]+"
INSTRUMENTS = "吉他|钢琴|双谱|器乐|非洲|尤克里里|古筝|琵琶|二胡|笛|萨克斯|总谱|合唱"


def title_group(title: Column) -> Column:
    """The part before ``__``, without zero-width signs, up to the first bracket or blank; all of it if that is empty."""
    base = F.regexp_replace(F.substring_index(F.coalesce(title, F.lit("")), "__", 1), ZERO_WIDTH, "")
    cut = F.regexp_extract(base, r"^([^\s（(【\[《]*)", 1)
    return F.when(cut != "", cut).otherwise(base)


def normal_title(title: Column) -> Column:
    """Lower case without bracketed notes, site words and separators; if nothing is left, only bracket signs are dropped."""

    def once(x: Column) -> Column:
        x = F.regexp_replace(F.regexp_replace(x, ZERO_WIDTH, ""), BRACKETED, "")
        return F.lower(F.regexp_replace(F.regexp_replace(x, SITE_WORDS, ""), SEPARATORS, ""))

    title = F.coalesce(title, F.lit(""))
    return F.when(once(title) != "", once(title)).otherwise(once(F.regexp_replace(title, BRACKETS, "")))


def match_grade(a: Column, b: Column) -> Column:
    """strict: equal; loose: one holds the other; missing: neither, or one is empty."""
    return (
        F.when((F.length(a) == 0) | (F.length(b) == 0), "missing").when(a == b, "strict")
        .when(a.contains(b) | b.contains(a), "loose").otherwise("missing")
    )


def same_title(a: Column, b: Column) -> Column:
    """Equal, or one holds the other, which has 4 characters and half of its length at least."""
    short, long_ = F.least(F.length(a), F.length(b)), F.greatest(F.length(a), F.length(b))
    return (a == b) | ((a.contains(b) | b.contains(a)) & (short >= 4) & (2 * short >= long_))


def page_title(html: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_extract(F.coalesce(html, F.lit("")), r"(?is)<title[^>]*>(.*?)</title>", 1), r"\s+", " "))


def site_key(url: Column) -> Column:
    """site-id of a page address: its host's first label and the last number of its path; null without either."""
    site, ident = F.regexp_extract(url, r"^https?://([^./]+)", 1), F.regexp_extract(url, r"^[^?#]*/(\d+)", 1)
    return F.when((site != "") & (ident != ""), F.concat_ws("-", site, ident))


def safe_name(name: Column, most: int = 120) -> Column:
    """A file name: reserved signs become underscores; cut to ``most`` characters."""
    return F.left(F.regexp_replace(F.trim(F.coalesce(name, F.lit(""))), r'[\\/:*?"<>|\r\n\t]+', "_"), F.lit(most))


def source_id(path: Column, index: Column) -> Column:
    return F.left(F.sha1(F.concat_ws("#", path, index.cast("string"))), F.lit(12))


def wilson(hits: Column, n: Column, z: float = 1.96) -> Column:
    """struct(low, high) of the score interval for a rate; null without trials."""
    p, zz = hits / n, z * z
    mid = p + zz / (2 * n)
    half = z * F.sqrt(p * (1 - p) / n + zz / (4 * n * n))
    bound = lambda x: F.round(F.least(F.greatest(x / (1 + zz / n), F.lit(0.0)), F.lit(1.0)), 6)
    return F.when(n > 0, F.struct(bound(mid - half).alias("low"), bound(mid + half).alias("high")))

"""Records about songs, pages and folders: gates, tiers, cascades, tags, pages, and who keeps which name."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from neumata.functions import tokens as T

# Statuses that count, limits of purity, beats of a token, and what is no note but may stand in a score.
GOOD_STATUS = ("ok", "ocr", "converted")
STAFF_HARD, STAFF_MOST, BAD_LINES = 5, 4, 5
BEAM_BEATS = {"q": 0.5, "s": 0.25, "d": 0.125, "h": 0.0625}
STRUCTURAL = r"^(?:[-~\[\]{}|]|[cqsdh]+-|[cqsdh]*~[cqsdh]*|\d+=[A-Ga-g#b].*|[1-9][0-9]*\[)$"
UUID = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
SOURCE = "^[a-z0-9]+-[0-9a-z_]+$"


def reasons(checks: dict[str, Column]) -> Column:
    """The names of the checks that hold, in order."""
    return F.array_compact(F.array(*(F.when(ok, F.lit(name)) for name, ok in checks.items())))


def status_counts(status: Column) -> Column:
    """Whether any of a list of statuses is one that counts."""
    return F.coalesce(F.arrays_overlap(status, F.array(*map(F.lit, GOOD_STATUS))), F.lit(False))


def low_digit(n_notes: Column, n_tokens: Column) -> Column:
    """Whether less than half of 40 tokens and more are notes."""
    return (n_tokens >= 40) & (2 * n_notes < n_tokens)


def impure(lines: Column, staff: Column) -> Column:
    """Whether a page is no plain numbered notation: by staff lines alone if they are many, else by dark lines and staff lines."""
    return (staff >= STAFF_HARD) | ((lines >= BAD_LINES) & (staff >= STAFF_MOST))


def song_rules() -> dict[str, Column]:
    """The twelve rules of a song record as conditions, but for the uniqueness of its file, which is no matter of one row."""
    tokens = F.filter(T.tokens_of(F.col("score")), lambda t: t != "|")
    bars, pitches = F.col("bars"), F.size(T.merged_notes(F.col("score")))
    rising = bars == F.array_sort(F.array_distinct(bars))
    return {
        "title": F.trim(F.coalesce("title", F.lit(""))) != "",
        "status": status_counts(F.col("status")),
        "source": (F.coalesce("source", F.lit("")) == "") | F.col("source").rlike(SOURCE) | (F.col("source") == "unknown"),
        "identifier": (F.coalesce("MBID", F.lit("")) == "") | F.col("MBID").rlike(UUID),
        "tags": F.size(F.array_except("usertag", "tag")) == 0,
        "notes": F.size(F.filter(tokens, T.is_note)) == F.col("n_notes"),
        "bars rise": rising,
        "bars bounded": (F.size(bars) == 0) | ((F.array_min(bars) >= 0) & (F.array_max(bars) <= pitches)),
        "beats": (F.col("beats_per_bar") > 0) & (F.col("beats_per_bar") <= 16),
        "sections": F.array_join(F.filter("sections", lambda s: s != ""), " | ") == F.col("score"),
        "tokens": F.size(F.filter(tokens, lambda t: ~T.is_note(t) & ~t.rlike(STRUCTURAL))) == 0,
        "link": (F.size("link") == 0) | F.forall("link", lambda u: u.rlike(r"^https?://[^\s/]+\.[^\s/]+(?:/\S*)?$")),
    }


def first_of_each(rows: DataFrame, keys: list[str], order: list[str], k: int, salts: int = 64) -> DataFrame:
    """The first ``k`` rows of each key by ``order``. Rows are numbered within salted parts first, of which tasks keep ``k`` a part
    before they shuffle, and then what is left of a key, k a part: no group is gathered whole."""
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(salts)))
    first = lambda df, *by: df.withColumn("_nth", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_nth") <= k).drop("_nth")
    return first(first(salted, *keys, "_salt").drop("_salt"), *keys).select(*keys, *(c for c in rows.columns if c not in keys))


def added(a: Column, b: Column) -> Column:
    """The values of a list and then those of another that it lacks, in order."""
    return F.concat(a, F.array_except(b, a))


def removed(a: Column, b: Column) -> Column:
    """The values of a list that another lacks, in order and as often as they stand there."""
    return F.filter(a, lambda x: ~F.array_contains(b, x))


def implied_tags(rows: DataFrame, key: str, closure: DataFrame) -> DataFrame:
    """(key, tags): the tags of each row with all they imply, less those negated (``!tag``) and all that imply these; in order of the
    tags given, each before what it implies, the nearest first, without repeats.

    ``rows`` has tags, an array; ``closure`` (ancestor, child, depth) is any table of what implies what, as ``corpus.closure`` gives it.
    Only a row's own tags and their ancestors meet in one place.
    """
    given = rows.select(key, F.posexplode("tags").alias("at", "tag"))
    kept = given.where(~F.col("tag").startswith("!"))
    gone = given.where(F.col("tag").startswith("!")).select(key, F.expr("substring(tag, 2)").alias("gone")).distinct()
    up = closure.groupBy("child", "ancestor").agg(F.min("depth").alias("depth"))
    above = kept.join(up, kept["tag"] == up["child"]).select(key, "at", F.col("ancestor").alias("tag"), "depth")
    every = kept.select(key, "at", "tag", F.lit(0).alias("depth")).unionByName(above).groupBy(key, "tag").agg(F.min(F.struct("at", "depth")).alias("place"))
    implies = up.select(F.col("child").alias("tag"), F.col("ancestor").alias("gone"))
    out = every.join(implies, "tag").join(gone, [key, "gone"]).select(key, "tag").union(gone.select(key, F.col("gone").alias("tag"))).distinct()
    left = every.join(out, [key, "tag"], "left_anti").groupBy(key).agg(F.array_sort(F.collect_list(F.struct("place", "tag"))).alias("t"))
    none = F.array().cast("array<string>")
    return rows.select(key).join(left, key, "left").select(key, F.coalesce(F.transform("t", lambda x: x["tag"]), none).alias("tags"))


def identifier_tier(title: Column, found: Column, artist_fits: Column, score: Column) -> Column:
    """high, medium, low or null: how sure a catalogue entry found for a title is."""
    bare = lambda c: F.regexp_replace(F.lower(c), r"\s+", "")
    letters = lambda c: F.array_distinct(F.filter(F.split(bare(c), ""), lambda x: x != ""))
    shared = F.size(F.array_intersect(letters(title), letters(found)))
    longer = F.greatest(F.length(bare(title)), F.length(bare(found)))
    exact = bare(title) == bare(found)
    near = (score >= 90) & (F.length(bare(found)) >= 2) & (2 * shared >= longer)
    sure = F.when(score >= 90, "medium").otherwise("low")
    return F.when(exact & artist_fits, F.when(score >= 90, "high").otherwise("medium")).when(exact | near, sure)


def page_evidence(title: Column, wanted: Column, url: Column, ident: Column, ident_counts: Column) -> Column:
    """title if the page's title holds the wanted one, id if its address ends in the wanted number and that counts; null otherwise."""
    bare = lambda c: F.lower(F.regexp_replace(c, r"[\s\-_.,]+", ""))
    by_title = (F.length(bare(wanted)) >= 2) & bare(title).contains(bare(wanted))
    by_ident = ident_counts & (F.regexp_extract(url, r"/p?([0-9a-z_]+)(?:\.html?)?$", 1) == ident) & (ident != "")
    return F.when(by_title, "title").when(by_ident, "id")


def triage(images: Column, dropped: Column, pages: Column) -> Column:
    """Why a score is short: no image, dropped pages, pages not read, or a short song."""
    return F.when(F.coalesce(images, F.lit(0)) == 0, "no image").when(dropped > 0, "dropped pages").when((images >= 2) | (pages >= 2), "pages not read").otherwise("short song")


def written_beats(token: Column) -> Column:
    """Beats of a token where dots add half of the last each and dashes a beat each; bar lines and what is no token have none."""
    pattern = r"^[#b',]*([qsdh]?)[#b',]*[0-7]([.,'\-]*)$"
    base = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for item in BEAM_BEATS.items() for x in item)), F.regexp_extract(token, pattern, 1)), F.lit(1.0))
    count = lambda sign: F.regexp_count(F.regexp_extract(token, pattern, 2), F.lit(sign))
    beats = base * (2 - F.pow(F.lit(0.5), count("[.]"))) + count("-")
    return F.when(token.isin("-", "."), 1.0).when(token.rlike(pattern), beats).otherwise(0.0)


def rests_for(missing: Column) -> Column:
    """Rest tokens that fill so many beats, to a sixteenth: whole ones first, then each half once at most."""
    n = F.round(missing * 16).cast("int")
    part = lambda bit, name: F.when(F.floor(n / bit) % 2 == 1, F.lit(name))
    return F.array_compact(F.concat(F.array_repeat(F.lit("0"), F.floor(n / 16).cast("int")), F.array(part(8, "q0"), part(4, "s0"), part(2, "d0"), part(1, "h0"))))


def rebarred(tokens: Column, per_bar: float) -> Column:
    """Tokens in bars of ``per_bar`` beats, the rest of each filled with rests; a token goes to the next bar if it does not fit."""
    bar = "struct<tokens:array<string>,beats:double>"

    def step(s: Column, t: Column) -> Column:
        beats = written_beats(t)
        over = (F.size(s["now"]) > 0) & (s["beats"] + beats > per_bar + 0.001)
        done = F.struct(s["now"].alias("tokens"), s["beats"].alias("beats"))
        return F.struct(
            F.when(over, F.array_append(s["out"], done)).otherwise(s["out"]).alias("out"),
            F.when(over, F.array(t)).otherwise(F.array_append(s["now"], t)).alias("now"),
            F.when(over, beats).otherwise(s["beats"] + beats).alias("beats"),
        )

    none = F.array().cast("array<string>")
    start = F.struct(F.array().cast(f"array<{bar}>").alias("out"), none.alias("now"), F.lit(0.0).alias("beats"))
    bars = F.aggregate(tokens, start, step, lambda s: F.when(F.size(s["now"]) > 0, F.array_append(s["out"], F.struct(s["now"].alias("tokens"), s["beats"].alias("beats")))).otherwise(s["out"]))
    return F.transform(bars, lambda b: F.concat(b["tokens"], F.when(b["beats"] < per_bar - 0.001, rests_for(per_bar - b["beats"])).otherwise(none)))


def token_parts(token: Column) -> Column:
    """struct(digit, accidental, voice, low, beam, dotted) of a token, its duration before or after the note."""
    bare = F.regexp_replace(token, r"\.", "")
    acc = F.when(bare.contains("#"), "#").when(bare.contains("b"), "b").otherwise("")
    body = F.when(bare.contains("#"), F.replace(bare, F.lit("#"), F.lit(""))).otherwise(F.replace(bare, F.lit("b"), F.lit("")))
    letter = F.coalesce(F.nullif(F.regexp_extract(body, "^([hdsqc])", 1), F.lit("")), F.nullif(F.regexp_extract(body, "([hdsqc])$", 1), F.lit("")))
    body = F.when(body.rlike("^[hdsqc]"), F.substring(body, 2, F.length(body))).when(body.rlike("[hdsqc]$"), F.left(body, F.length(body) - 1)).otherwise(body)
    beam = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for i in {"h": 4, "d": 3, "s": 2, "q": 1, "c": 0}.items() for x in i)), letter), F.lit(0))
    count = lambda sign: F.regexp_count(body, F.lit(sign))
    return F.struct(
        F.regexp_replace(body, "[',]", "").alias("digit"), acc.alias("accidental"), F.repeat(F.lit("'"), count("'")).alias("voice"),
        count(",").alias("low"), beam.alias("beam"), F.regexp_count(token, F.lit("[.]")).alias("dotted"),
    )


def token_of(parts: Column) -> Column:
    """The token of ``token_parts``, its duration first."""
    letter = F.get(F.array(*map(F.lit, ("", "q", "s", "d", "h"))), parts["beam"])
    return F.concat(letter, parts["accidental"], F.repeat(F.lit(","), parts["low"]), parts["voice"], parts["digit"], F.repeat(F.lit("."), parts["dotted"]))


def high_after(token: Column) -> Column:
    """A token with its high-octave marks behind the note, where they belong, and low ones before it."""
    pattern = r"^([qsdh]*)([,']*)([1-7x0])([.,'qsdh-]*)$"
    part = lambda k: F.regexp_extract(token, pattern, k)
    marks = lambda sign: F.repeat(F.lit(sign), F.regexp_count(part(2), F.lit(sign)))
    return F.when(token.rlike(pattern), F.concat(part(1), marks(","), part(3), marks("'"), F.replace(part(4), F.lit("'"), F.lit("")))).otherwise(token)


def minor_lowered(token: Column) -> Column:
    """A sixth degree, the tonic of a minor key, an octave lower: one high mark less, or one low mark more."""
    pattern = r"^([sqdhc]?)6('+|,+)?([.\-]*)$"
    part = lambda k: F.regexp_extract(token, pattern, k)
    lower = F.when(part(2).startswith("'"), F.concat(part(1), F.lit("6"), F.substring(part(2), 2, 99), part(3))).otherwise(F.concat(part(1), F.lit(","), part(2), F.lit("6"), part(3)))
    return F.when(token.rlike(pattern), lower).otherwise(token)


def controls(text: Column) -> Column:
    """struct(key, metre, tempo, body) of a model's text: its #KEY, #TIME and #TEMPO lines, the last of each, and the rest."""
    lines = F.split(text, "\r?\n", -1)
    last = lambda tag: F.element_at(F.concat(F.array(F.lit(None).cast("string")), F.transform(F.filter(lines, lambda x: F.trim(x).startswith(tag)), lambda x: F.trim(F.substring(F.trim(x), len(tag) + 1, 10_000)))), -1)
    given = lambda c: F.when(~F.lower(c).isin("none", "无", "-", ""), c)
    rest = F.filter(lines, lambda x: ~F.trim(x).rlike("^#(?:KEY|TIME|TEMPO)"))
    metre = F.nullif(F.regexp_extract(last("#TIME"), r"(\d+/\d+)", 1), F.lit(""))
    return F.struct(given(last("#KEY")).alias("key"), metre.alias("metre"), given(last("#TEMPO")).alias("tempo"), F.trim(F.array_join(rest, "\n")).alias("body"))


@F.pandas_udf(ArrayType(StringType()))
def wrapped(tokens: pd.Series, width: pd.Series) -> pd.Series:
    """Tokens in lines of ``width`` signs at most, as far as single tokens allow; one pass over each score, however long."""

    def lines(some, most: int) -> list[str]:
        out, now, n = [], [], 0
        for t in some:
            if now and n + 1 + len(t) > most:
                out.append(" ".join(now))
                now, n = [], 0
            n += len(t) + (1 if now else 0)
            now.append(t)
        return [*out, " ".join(now)] if now else out

    return pd.Series([None if t is None else lines(t, w) for t, w in zip(tokens, width, strict=True)])


def chosen_page(pages: DataFrame, folder: str) -> DataFrame:
    """(folder, name): the page of an image folder that holds the score: on a site that begins with a title strip (``second_first``)
    the page numbered 2; else the largest file or, if that is landscape, the first portrait page. Of files alike in size, number and name
    a portrait page goes first. Pages of 100 pixels and less do not count. ``pages`` has name, number, width, height, size and second_first."""
    real = pages.where((F.col("width") > 100) & (F.col("height") > 100)).withColumn("portrait", 10 * F.col("height") >= 13 * F.col("width"))
    by_size = F.min_by(F.struct("name", "portrait"), F.struct((-F.col("size")).alias("s"), "number", "name", (~F.col("portrait")).alias("landscape")))
    first = F.min(F.when(F.col("portrait"), F.struct("number", "name")))
    second = F.min(F.when(F.col("second_first") & (F.col("number") == 2), F.col("name")))
    best = real.groupBy(folder).agg(by_size.alias("largest"), first.alias("first"), second.alias("second"))
    plain = F.when(F.col("largest.portrait") | F.col("first").isNull(), F.col("largest.name")).otherwise(F.col("first.name"))
    return best.select(folder, F.coalesce("second", plain).alias("name"))


def grouped_onsets(notes: Column, most: int) -> Column:
    """Sizes of groups of notes (gap to the one before) that begin within ``most`` ticks of the first note of their group."""

    def step(s: Column, x: Column) -> Column:
        now = s["now"] + x["gap"]
        new = (F.size(s["out"]) == 0) | (now - s["start"] > most)
        last = F.coalesce(F.element_at(F.concat(F.array(F.lit(0)), s["out"]), -1), F.lit(0))
        grown = F.concat(F.slice(s["out"], 1, F.greatest(F.size(s["out"]) - 1, F.lit(0))), F.array(last + 1))
        return F.struct(now.alias("now"), F.when(new, now).otherwise(s["start"]).alias("start"), F.when(new, F.array_append(s["out"], F.lit(1))).otherwise(grown).alias("out"))

    start = F.struct(F.lit(0).cast("long").alias("now"), F.lit(0).cast("long").alias("start"), F.array().cast("array<int>").alias("out"))
    return F.aggregate(notes, start, step, lambda s: s["out"])


def page_details(pages: DataFrame) -> DataFrame:
    """(page_id, images, next): the sources of a page's images in order, and the link to the next page of a list, if there is one."""
    html = F.coalesce("html", F.lit(""))
    got = lambda pattern: F.regexp_extract_all(html, F.lit(pattern), F.lit(1))
    following = F.get(got(r'(?is)<a[^>]*href="([^"]*)"[^>]*>\s*(?:next|下一页)'), F.lit(0))
    return pages.select("page_id", got(r'(?is)<img[^>]*src="([^"]*)"').alias("images"), following.alias("next"))


def row_bands(rows: DataFrame, least: int, share: float) -> DataFrame:
    """(page, first, n): runs of neighbouring rows whose dark pixels are more than ``least`` and than a share of the page's most."""
    peak = rows.groupBy("page").agg(F.max("dark").alias("peak"))
    text = rows.join(peak, "page").where(F.col("dark") > F.greatest(F.lit(float(least)), share * F.col("peak"))).select("page", "row").distinct()
    island = F.col("row") - F.row_number().over(Window.partitionBy("page").orderBy("row"))
    return text.withColumn("island", island).groupBy("page", "island").agg(F.min("row").alias("first"), F.count("*").alias("n")).drop("island")


def is_note_band(tall_share: Column, tall: Column, underlines: Column) -> Column:
    return (tall_share >= 0.85) | ((tall >= 6) & (underlines >= 1))


def geometry(beams: Column, low: Column, high: Column, dots: Column) -> Column:
    """struct(beam, low, high, dot): marks of a note counted from its components, with 4, 3, 1 and 1 at most."""
    return F.struct(*(F.least(c, F.lit(most)).alias(name) for name, c, most in (("beam", beams, 4), ("low", low, 3), ("high", high, 1), ("dot", dots, 1))))


# The major keys along the circle of fifths, from C upward.
MAJOR_KEYS = ("C", "G", "D", "A", "E", "B", "F#", "Db", "Ab", "Eb", "Bb", "F")


def major_key(tonic: Column) -> Column:
    """struct(major, fifths) of the major key on a pitch class: its name, and sharps (flats below zero)."""
    at = F.pmod(tonic * 7, F.lit(12))
    return F.struct(F.get(F.array(*map(F.lit, MAJOR_KEYS)), at).alias("major"), F.when(at > 6, at - 12).otherwise(at).cast("int").alias("fifths"))

"""Names of files, pages and scores: repair, titles, artists, keys and what looks wrong about them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from neumata.functions.common import let
from neumata.functions.titles import INSTRUMENTS

# Words after which a title ends, markers and stop words of artists, suffixes and signs, and what odd names hold.
INVISIBLE = "[\u200b-\u200f\u202a-\u202e\u2060\ufeff]"
HAN = "一-鿿"
CREDITS = "原创曲|萨克斯风|萨克斯|词曲|作词|作曲|演唱|制谱|弹唱|演奏|简谱"
MARKERS = (
    "尤克里里弹唱谱|吉他弹唱谱|尤克里里谱|小提琴谱|手风琴谱|电子琴谱|钢琴谱|吉他谱|葫芦丝谱|萨克斯谱|古筝谱|二胡谱|笛箫谱|弹唱谱|原版谱|简谱|曲谱|歌谱"
    "|（歌词）|[(]歌词[)]|（简谱）|[(]简谱[)]"
)
NO_ARTIST = "儿歌|歌词|动画|影视|主题曲|插曲|片尾曲|片头曲|简谱|曲谱|歌谱|伴奏|弹唱|合唱|独唱|钢琴|吉他|版本|现场|录音|混音|串烧|翻唱|原唱|记谱|制谱"
TYPE_SUFFIXES = (
    "简谱|歌曲类|歌谱|钢琴简谱|钢琴谱|钢琴|正谱|双谱|总谱|弹唱谱|指弹谱|尤克里里谱|五线谱|歌词|伴奏谱|原版编配|指法|合唱谱|独奏|弹唱|扫描版|纯享版|原唱|演唱|独唱|吉他谱|吉他"
)
LOOSE_SIGNS = r"[\s《》〈〉（）()\[\]【】、，,。.!！?？:：;；·・\-—_…~～'\"“”‘’/\\|&]+"
VERSION_WORDS = "简谱|钢琴谱|钢琴|吉他谱|吉他|正谱|双谱|总谱|弹唱谱|指弹谱|尤克里里谱|五线谱|歌词|伴奏谱|原版编配|指法|[CGFDAEB]调|合唱谱|独奏|弹唱|扫描版|不同版本"
VERSION_SIGNS = r"[\s_·.,，。、:：;；!！?？'\"“”‘’/\\|+*#@&$%^~`<>\[\]{}]+"
CREDIT_NOTE = "[词曲唱佚]"
FAMILY_SUFFIX = r"(?:[-_（(]?\s*(?:简谱|歌曲类|歌谱|五线谱|正谱|完整版|弹唱|吉他谱|钢琴谱)\s*[)）]?)+$"
META = "作词|作曲|词曲|记谱|编配|演唱|原唱|又名|选自|专辑|版本|汉语版|粤语版|国语版|普通话|闽南语|日语版|英文版|女声版|男声版|独唱版|童声版|翻唱|改编"
CREDITED = f"[{HAN}]{{2,4}}词[{HAN}]{{0,4}}曲"
ODD_INSTRUMENTS = (
    "钢琴|吉他|尤克里里|乌克丽丽|指弹|弹唱|扫弦|架子鼓|爵士鼓|萨克斯|小提琴|大提琴|古筝|琵琶|二胡|竹笛|笛子|葫芦丝|陶笛|口琴|手风琴|电子琴|竖琴|卡林巴|拇指琴"
    "|伴奏|纯音乐|和弦|简和谱|双谱|五线谱|六线谱"
)
KEY_OR_SPEED = r"[A-G][#b]?\s*调|\d\s*/\s*\d\s*拍|♩|BPM"
EDGES = r"^[\s_\-·、,，.]+|[\s_\-·、,，]+$"
UNNAMED = "未命名"


def repaired(text: Column) -> Column:
    """Text whose UTF-8 bytes were once read as Latin-1, read rightly. Other text stays as it is, also text beyond Latin-1.

    If the bytes are no UTF-8, what can be read of them without control signs is taken
    if it has Han characters.
    """
    latin = ~text.rlike("[^\\x00-\\xff]")
    data = F.encode(F.when(latin, text).otherwise(""), "ISO-8859-1").cast("string")
    loss = F.trim(F.regexp_replace(F.make_valid_utf8(data), "[\\x00-\\x1f\\x7f-\\x9f\ufffd]", ""))
    whole = F.nullif(F.try_validate_utf8(data), F.lit(""))
    return F.when(latin, F.coalesce(whole, F.when(loss.rlike(f"[{HAN}]"), loss), text)).otherwise(text)


def _bare(text: Column) -> Column:
    return F.lower(F.regexp_replace(text, f"[^0-9A-Za-z{HAN}]", ""))


def doubled_at(text: Column) -> Column:
    """Where a text that says the same twice in a row has its second half, looked for in its middle third; null otherwise.

    Signs and case do not count; a blank between the halves says that it is meant.
    """
    n, third = F.length(text), F.greatest(F.floor(F.length(text) / 3).cast("int"), F.lit(1))
    ends = F.when(n - third >= third, F.sequence(third, n - third)).otherwise(F.array().cast("array<int>"))
    half = lambda i: _bare(F.left(text, i))

    def same(i: Column) -> Column:
        joined = ~F.substring(text, i, F.lit(2)).rlike(r"\s")
        return joined & (F.length(half(i)) >= 3) & (half(i) == _bare(F.substring(text, i + 1, n)))

    return F.get(F.filter(ends, same), F.lit(0))


def title_of(name: Column) -> Column:
    """The title in a folder's or file's name ``title__site-id``: repaired, without site words, notes in brackets, numbers of a
    collection and doubling; a placeholder with the site and number if nothing readable is left."""
    base = F.regexp_replace(F.trim(repaired(F.substring_index(name, "__", 1))), INVISIBLE, "")
    base = F.regexp_replace(F.regexp_replace(base, f"(?:{CREDITS}).*$", ""), "[_-]?[（(][^（()）]*[)）]", "")
    base = F.regexp_replace(base, f"^[0-9]{{1,3}}([{HAN}])", "$1")

    def once(b: Column) -> Column:
        def half(at: Column) -> Column:
            first, second = F.left(b, at), F.substring(b, at + 1, F.length(b))
            marks = lambda x: F.length(x) - F.length(F.replace(x, F.lit("_"), F.lit("")))
            return F.when(at.isNull(), b).when(marks(first) <= marks(second), first).otherwise(second)

        return let(doubled_at(b), half)

    def named(b: Column) -> Column:
        broken = b.rlike("[À-ÿ]") & (F.length(b) - F.length(F.regexp_replace(b, f"[{HAN}]", "")) < 2)
        site = F.regexp_extract(name, "([A-Za-z]+[0-9]*-[0-9]+)$", 1)
        none = F.when(site != "", F.concat(F.lit(f"{UNNAMED}-"), site)).otherwise(UNNAMED)
        return F.when(~b.rlike(f"[{HAN}A-Za-z0-9]") | broken, none).otherwise(b)

    return let(F.regexp_replace(let(base, once), "^[_ -]+|[_ -]+$", ""), named)


def clean_title(raw: Column) -> Column:
    """A crawled title up to its first marker, then up to its first separator that is not at an edge."""
    text = F.trim(F.replace(F.replace(F.coalesce(raw, F.lit("")), F.lit("&nbsp;"), F.lit(" ")), F.lit("&amp;"), F.lit("&")))
    text = F.regexp_replace(text, f"(?s)(?:{MARKERS}).*$", "")

    def before(sign: str) -> Callable[[Column], Column]:
        at = lambda t: F.instr(t, sign)
        return lambda t: F.when((at(t) > 1) & (at(t) < F.length(t)), F.left(t, at(t) - 1)).otherwise(t)

    for sign in "_—–-":
        text = let(text, before(sign))
    return F.regexp_replace(F.trim(text), "^[。！!· ]+|[。！!· ]+$", "")


def guessed_artist(raw: Column) -> Column:
    """Who sings by the title: the name before 演唱, or the part after a first part that speaks of a score; empty otherwise."""
    raw = F.coalesce(raw, F.lit(""))
    sung = F.regexp_extract(raw, "([一-龥A-Za-z0-9·]{1,8})演唱", 1)

    def second(sign: str) -> Column:
        parts = F.array_remove(F.split(raw, sign), "")
        who = F.trim(F.get(parts, F.lit(1)))
        fits = F.get(parts, F.lit(0)).rlike("简谱|歌词|曲谱|歌谱") & (who != "") & ~who.rlike(NO_ARTIST) & (F.length(who) <= 8) & ~who.rlike(r"[0-9]")
        return F.when((F.size(parts) >= 2) & fits, who)

    return F.when(sung != "", sung).otherwise(F.coalesce(*(second(s) for s in "_—–-"), F.lit("")))


def canonical(title: Column) -> Column:
    """A title without signs, type suffixes, however many, and a number before Han characters; as it is without signs if nothing is left."""
    bare = F.lower(F.regexp_replace(F.regexp_replace(F.coalesce(title, F.lit("")), INVISIBLE, ""), LOOSE_SIGNS, ""))
    cut = F.regexp_replace(bare, f"^(.+?)(?:{TYPE_SUFFIXES})+$", "$1")
    return let(cut, lambda c: F.coalesce(F.nullif(F.regexp_replace(c, f"^[0-9]{{1,3}}([{HAN}])", "$1"), F.lit("")), c))


def version_key(folder: Column) -> Column:
    """The song of a version's folder: credits in brackets stay, other notes, version words, class words and signs go."""
    text = F.regexp_replace(folder, r"__[a-z0-9]+-\d+$", "")
    text = F.regexp_replace(text, f"[（(【\\[]([^)）】\\]]*{CREDIT_NOTE}[^)）】\\]]*)[)）】\\]]", "\u0001$1\u0002")
    text = F.regexp_replace(F.regexp_replace(text, r"[（(【\[][^)）】\]]*[)）】\]]", ""), r"[（(【\[].*$", "")
    text = F.replace(F.replace(text, F.lit("\u0001"), F.lit("(")), F.lit("\u0002"), F.lit(")"))
    text = F.regexp_replace(F.regexp_replace(text, VERSION_WORDS, ""), r"[\s　]*\S*类[\s　]+\S*$", "")
    text = F.regexp_replace(F.regexp_replace(text, r"[\s　]*\S*类$", ""), VERSION_SIGNS, "")
    return F.trim(F.lower(text))


def family_key(group: Column, rounds: int = 3) -> Column:
    """A title group without type suffixes and a single digit after Han characters; never empty."""
    for _ in range(rounds):
        cut = F.regexp_replace(F.regexp_replace(group, FAMILY_SUFFIX, ""), f"([{HAN}])[0-9]$", "$1")
        group = F.coalesce(F.nullif(cut, F.lit("")), group)
    return group


def site_and_id(name: Column) -> Column:
    """struct(site, ident) of ``title__site-id``, with or without a file suffix; both empty otherwise."""
    base = F.trim(F.substring_index(F.coalesce(name, F.lit("")), "/", -1))
    got = lambda text, k: F.regexp_extract(text, r"__([a-z0-9]+)-([0-9a-z_]+)$", k)
    stem = F.regexp_replace(base, r"(.)\.[^.]*$", "$1")
    pick = lambda k: F.when(got(base, 1) != "", got(base, k)).otherwise(got(stem, k))
    return F.struct(pick(1).alias("site"), pick(2).alias("ident"))


def folder_key(name: Column) -> Column:
    """site-id of a name, or the name itself."""
    base = F.trim(F.substring_index(F.coalesce(name, F.lit("")), "/", -1))
    return let(site_and_id(name), lambda s: F.when(s["site"] != "", F.concat_ws("-", s["site"], s["ident"])).otherwise(base))


def oddities(title: Column) -> Column:
    """What looks wrong about a title, as a list in fixed order."""
    checks = {
        "underscore": title.contains("_") & title.rlike(f"[{HAN}]"),
        "credits": title.rlike(META) | title.rlike(CREDITED),
        "instrument": title.rlike(ODD_INSTRUMENTS),
        "key or speed": title.rlike(KEY_OR_SPEED),
        "doubled": doubled_at(title).isNotNull(),
        "long": F.length(title) > 24,
        "placeholder": title.startswith(UNNAMED),
        "edge signs": title.rlike(EDGES),
        "site number": title.rlike("[0-9]{6,}"),
    }
    return F.array_compact(F.array(*(F.when(ok, F.lit(name)) for name, ok in checks.items())))


def is_arrangement(name: Column) -> Column:
    """Whether a name speaks of an arrangement for an instrument or several voices."""
    return name.rlike(INSTRUMENTS)


def accepted_title(title: Column, before: Column, changed: Column) -> Column:
    """Whether a proposed title is taken over: marked as changed, another one, not empty, no question mark alone, one line of 40 characters at most."""
    fits = ~title.isin("", "?") & (title != before) & (F.length(title) <= 40) & ~title.contains("\n")
    return F.coalesce((changed == 1) & fits, F.lit(False))

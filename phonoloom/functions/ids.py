"""Item ids, what addresses say, and batch names, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Patterns of video numbers in addresses, in the order in which they are tried.
TIKTOK_PATTERNS = [r"/@[A-Za-z0-9._%-]+/video/(\d{8,19})", r"/video/(\d{8,19})"]
FACEBOOK_PATTERNS = [(r"/reel/(\d{8,})", "reel"), (r"/videos/(?:[^/?#]+/)?(\d{8,})", "video"), (r"[?&]v=(\d{8,})", "video"), (r'"video_id"\s*:\s*"(\d{8,})"', "video"), (r'"videoId"\s*:\s*"(\d{8,})"', "video"), (r"story_fbid=(\d{8,})", "video")]


def first_group(text: Column, pattern: str) -> Column:
    """Group 1 of the first match, null if there is none."""
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def tiktok_id(url: Column) -> Column:
    """``tt_<number>`` of a video address; photo posts and other addresses give null."""
    number = F.coalesce(*[first_group(url, p) for p in TIKTOK_PATTERNS])
    return F.when(~F.contains(url, F.lit("/photo/")), F.concat(F.lit("tt_"), number))


def facebook_id(url: Column) -> Column:
    """``fb_<number>`` by the first pattern that matches, else null."""
    return F.concat(F.lit("fb_"), F.coalesce(*[first_group(url, p) for p, _ in FACEBOOK_PATTERNS]))


def facebook_kind(url: Column) -> Column:
    """``reel`` or ``video``, by the pattern that gives the id; ``video`` where none does."""
    kind = F.when(F.lit(False), F.lit(""))
    for pattern, name in FACEBOOK_PATTERNS:
        kind = kind.when(url.rlike(pattern), F.lit(name))
    return kind.otherwise(F.lit("video"))


def address_id(url: Column, prefix: str = "tt_") -> Column:
    """The last path segment if it is a number, else the first 16 hex digits of the address's MD5."""
    path = F.regexp_replace(F.split_part(url, F.lit("?"), F.lit(1)), "/+$", "")
    last = F.element_at(F.split(path, "/"), -1)
    return F.concat(F.lit(prefix), F.when(last.rlike("^[0-9]+$"), last).otherwise(F.substring(F.md5(url), 1, 16)))


def base_id(item_id: Column) -> Column:
    """The id without a segment suffix of one to three digits. An id whose rest is a bare number of fewer than
    eight digits keeps it: that number is the id itself."""
    return F.when(item_id.rlike(r"^(tt|fb)_\d{1,7}$"), item_id).otherwise(F.regexp_replace(item_id, r"_\d{1,3}$", ""))


def raw_id(item_id: Column) -> Column:
    """What follows the platform's prefix, up to the next underscore; without prefix, what stands before one."""
    return F.regexp_extract(item_id, r"^(?:tt_|fb_)?([^_]*)", 1)


def platform(item_id: Column) -> Column:
    """The platform that the prefix stands for."""
    return F.when(item_id.startswith("tt_"), F.lit("tiktok")).when(item_id.startswith("fb_"), F.lit("facebook")).otherwise(F.lit("unknown"))


def segment_id(item_id: Column, index: Column, total: Column) -> Column:
    """``<id>_NN``; an item that is one piece keeps its id."""
    return F.when(total <= 1, item_id).otherwise(F.format_string("%s_%02d", item_id, index))


def batch_id(platform_name: Column, day: Column, number: Column) -> Column:
    """``tt_YYYYMMDD_NN`` or ``fb_YYYYMMDD_NN``."""
    return F.concat_ws("_", F.when(platform_name == "tiktok", F.lit("tt")).otherwise(F.lit("fb")), F.date_format(day, "yyyyMMdd"), F.lpad(number.cast("string"), 2, "0"))


def addresses_in(text: Column, hosts: tuple[str, ...]) -> Column:
    """All addresses of the hosts in a text, in order, in any case."""
    names = "|".join(h.replace(".", r"\.") for h in hosts)
    return F.regexp_extract_all(text, F.lit(rf"(?i)(https?://(?:[a-z]+\.)?(?:{names})/[^\x{{09}}-\x{{0d}}\x{{20}}]+)"), F.lit(1))


# How a page names videos, in order of preference.
PAGE_PATTERNS = [r"/@[A-Za-z0-9._%-]+/video/(\d{8,19})", r"/video/(\d{15,})", r'"id"\s*:\s*"(\d{15,})"']


def page_links(html: Column) -> Column:
    """Video numbers of a page, each once in the order of first sight: those of the first of three patterns that
    gives any (handle and number, number alone, id in embedded JSON)."""
    text = F.replace(html, F.lit("\\/"), F.lit("/"))
    tries = [F.array_distinct(F.regexp_extract_all(text, F.lit(p), F.lit(1))) for p in PAGE_PATTERNS]
    return F.when(F.size(tries[0]) > 0, tries[0]).when(F.size(tries[1]) > 0, tries[1]).otherwise(tries[2])


def page_links_all(html: Column, most: int, reel: str, video: str) -> Column:
    """Addresses from all patterns of the second platform together, each once, the first ``most``; ``reel`` and ``video``
    are what stands before the number of either kind."""
    parts = []
    for pattern, kind in FACEBOOK_PATTERNS:
        head = reel if kind == "reel" else video
        parts.append(F.transform(F.regexp_extract_all(html, F.lit(pattern), F.lit(1)), lambda v, head=head: F.concat(F.lit(head), v)))
    return F.slice(F.array_distinct(F.concat(*parts)), 1, most)

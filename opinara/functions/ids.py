"""Identifiers, web addresses and other single values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as V
from .text import normalize_space


def none_if_blank(value: Column) -> Column:
    return F.when(value != "", value)


def item_comment_id(item_id: Column, comment_id: Column, platform: str = "bilibili") -> Column:
    """Stable id of a comment below an item: digest of platform, item and own id."""
    return F.md5(F.concat_ws("_", F.lit(platform), item_id, comment_id))


def content_comment_id(post_url: Column, content: Column, prefix: str = "weibo_comment_") -> Column:
    """Id from address and text, equal in every run."""
    return F.concat(F.lit(prefix), F.md5(F.concat(post_url, content)))


def video_id(text: Column) -> Column:
    return none_if_blank(F.regexp_extract(text, "BV[0-9A-Za-z]+", 0))


def video_url(text: Column, prefix: str = V.VIDEO_URL_PREFIX) -> Column:
    """Canonical address of the video named in a text, null without one."""
    return F.concat(F.lit(prefix), video_id(text))


def absolute_url(url: Column, host: str = V.POST_HOST) -> Column:
    url = F.coalesce(url, F.lit(""))
    return (
        F.when(url.startswith("//"), F.concat(F.lit("https:"), url))
        .when(url.startswith("/"), F.concat(F.lit(host), url))
        .otherwise(url)
    )


def mobile_url(
    url: Column, mark: str = V.MOBILE_DETAIL_MARK, prefix: str = V.MOBILE_DETAIL_PREFIX
) -> Column:
    """Mobile detail address for ``/user/post`` paths, other addresses unchanged."""
    url = absolute_url(url)
    path = F.regexp_extract(url, r"^(?:[^:/?#]+:)?(?://[^/?#]*)?([^?#]*)", 1)
    path = F.btrim(F.regexp_replace(path, r";[^/]*$", ""), F.lit("/"))
    last = F.regexp_extract(path, r"/([A-Za-z0-9]+)$", 1)
    return (
        F.when(url.contains(mark), F.substring_index(url, "?", 1))
        .when(last != "", F.concat(F.lit(prefix), last))
        .otherwise(url)
    )


def percent_encode(text: Column, safe_slash: bool = True, plus_for_space: bool = False) -> Column:
    """Percent-encoded text; ``url_encode`` differs in a few characters."""
    out = F.replace(F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))
    if not plus_for_space:
        out = F.replace(out, F.lit("+"), F.lit("%20"))
    return F.replace(out, F.lit("%2F"), F.lit("/")) if safe_slash else out


def post_search_url(keyword: Column, page: Column, base: str = V.POST_SEARCH_URL) -> Column:
    return F.concat(
        F.lit(base + "?q="), percent_encode(keyword), F.lit("&page="), page.cast("string")
    )


def video_search_url(keyword: Column, page: Column, base: str = V.VIDEO_SEARCH_URL) -> Column:
    encoded = percent_encode(keyword, safe_slash=False, plus_for_space=True)
    return F.concat(F.lit(base + "?keyword="), encoded, F.lit("&page="), page.cast("string"))


def like_count(text: Column) -> Column:
    """Shown like count as a number: plain digits, ``1.2万`` or ``3.4K``; else 0."""
    shown = F.translate(normalize_space(text), "０１２３４５６７８９", "0123456789")
    shown = F.replace(shown, F.lit(","), F.lit(""))

    def scaled(pattern: str, factor: int) -> Column:
        number = F.regexp_extract(shown, pattern, 1).try_cast("double")
        return (number * F.lit(float(factor))).cast("long")

    wan, kilo = r"(\d+(?:\.\d+)?) *万", r"(\d+(?:\.\d+)?) *[kK]"
    return (
        F.when(shown.rlike(wan), scaled(wan, 10000))
        .when(shown.rlike(kilo), scaled(kilo, 1000))
        .when(shown.rlike(r"^\d+$"), F.coalesce(shown.try_cast("long"), F.lit(0).cast("long")))
        .otherwise(F.lit(0).cast("long"))
    )


def epoch_text(value: Column, zone: str = "UTC") -> Column:
    """Epoch seconds as ``yyyy-MM-dd HH:mm:ss``, other input as cleaned text."""
    seconds = value.cast("string").try_cast("long")
    moment = F.timestamp_add("SECOND", seconds, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), moment)
    return F.coalesce(F.date_format(local, "yyyy-MM-dd HH:mm:ss"), normalize_space(value))


TIME_FORMATS = ("yyyy/M/d H:mm:ss", "yyyy/M/d H:mm", "yyyy/M/d", "yyyy.M.d", "yyyyMMdd")


def lenient_time(value: Column, formats: tuple[str, ...] = TIME_FORMATS) -> Column:
    """Time without zone from text, null where no format fits."""
    text = F.trim(value.cast("string"))
    tries = [text.try_cast("timestamp_ntz")]
    tries += [F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.when(text.rlike(r"^\d{4}[-/.\d]"), F.coalesce(*tries))


def none_if_zero(value: Column) -> Column:
    return F.when(value != 0, value)


def first_truthy(*values: Column) -> Column:
    """First value that is not null, as text.

    Callers blank out what does not count: ``none_if_blank`` for texts,
    ``none_if_zero`` for numbers.
    """
    return F.coalesce(*[v.cast("string") for v in values])


def json_field(payload: Column, path: str, default: Column) -> Column:
    return F.coalesce(F.get_json_object(payload, path), default)


def platform_name(name: Column, names: dict[str, str] | None = None) -> Column:
    """Readable platform name, unknown names pass through."""
    key = F.trim(name)
    chosen = F.when(F.lit(False), "")
    for raw, shown in (names or V.PLATFORM_NAMES).items():
        chosen = chosen.when(key == raw, shown)
    return chosen.otherwise(key)

"""Text normalisation and cleaning.

Java's ``\\s`` and ``\\w`` are ASCII by default, so the Unicode classes are spelled out.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters the cleaning rules speak about.
WS = r"[\s\x1c-\x1f\x85\p{Z}]"
NOT_WS = r"[^\s\x1c-\x1f\x85\p{Z}]"
WORD = r"[\p{L}\p{N}_]"
WS_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Code points with the Unicode Emoji property, without the ASCII
# digits, '#', '*' (emoji only inside a keycap) and the regional indicators
# (emoji only in pairs).
EMOJI_RANGES = """
A9 AE 203C 2049 2122 2139 2194-2199 21A9-21AA 231A-231B 2328 23CF 23E9-23F3 23F8-23FA
24C2 25AA-25AB 25B6 25C0 25FB-25FE 2600-2604 260E 2611 2614-2615 2618 261D 2620 2622-2623
2626 262A 262E-262F 2638-263A 2640 2642 2648-2653 265F-2660 2663 2665-2666 2668 267B
267E-267F 2692-2697 2699 269B-269C 26A0-26A1 26A7 26AA-26AB 26B0-26B1 26BD-26BE 26C4-26C5
26C8 26CE-26CF 26D1 26D3-26D4 26E9-26EA 26F0-26F5 26F7-26FA 26FD 2702 2705 2708-270D 270F
2712 2714 2716 271D 2721 2728 2733-2734 2744 2747 274C 274E 2753-2755 2757 2763-2764
2795-2797 27A1 27B0 27BF 2934-2935 2B05-2B07 2B1B-2B1C 2B50 2B55 3030 303D 3297 3299
1F004 1F0CF 1F170-1F171 1F17E-1F17F 1F18E 1F191-1F19A 1F201-1F202 1F21A 1F22F 1F232-1F23A
1F250-1F251 1F300-1F321 1F324-1F393 1F396-1F397 1F399-1F39B 1F39E-1F3F0 1F3F3-1F3F5
1F3F7-1F4FD 1F4FF-1F53D 1F549-1F54E 1F550-1F567 1F56F-1F570 1F573-1F57A 1F587 1F58A-1F58D
1F590 1F595-1F596 1F5A4-1F5A5 1F5A8 1F5B1-1F5B2 1F5BC 1F5C2-1F5C4 1F5D1-1F5D3 1F5DC-1F5DE
1F5E1 1F5E3 1F5E8 1F5EF 1F5F3 1F5FA-1F64F 1F680-1F6C5 1F6CB-1F6D2 1F6D5-1F6D7 1F6DC-1F6E5
1F6E9 1F6EB-1F6EC 1F6F0 1F6F3-1F6FC 1F7E0-1F7EB 1F7F0 1F90C-1F93A 1F93C-1F945 1F947-1F9FF
1FA70-1FA7C 1FA80-1FA89 1FA8F-1FAC6 1FACE-1FADC 1FADF-1FAE9 1FAF0-1FAF8
"""


def _char_class(ranges: str) -> str:
    parts = []
    for item in ranges.split():
        ends = [rf"\x{{{end}}}" for end in item.split("-")]
        parts.append("-".join(ends))
    return "[" + "".join(parts) + "]"


_EMOJI = _char_class(EMOJI_RANGES)
_STYLE = r"(?:\x{FE0F}|[\x{1F3FB}-\x{1F3FF}])?"
_TAGS = r"(?:[\x{E0020}-\x{E007E}]+\x{E007F})?"
_FLAG = r"[\x{1F1E6}-\x{1F1FF}]{2}"
_KEYCAP = r"[0-9#*]\x{FE0F}?\x{20E3}"
_SEQUENCE = rf"{_EMOJI}{_STYLE}{_TAGS}(?:\x{{200D}}{_EMOJI}{_STYLE})*"

# One emoji sequence. A style selector or joiner goes only together with an emoji.
EMOJI = rf"{_KEYCAP}|{_FLAG}|{_SEQUENCE}"

# Every emoji sequence holds one of these few ranges, so most characters can be
# refused by a short test before the long class is tried.
EMOJI_HINT = r"[\x{A9}\x{AE}\x{203C}-\x{3299}\x{1F004}-\x{1FAF8}]"
_EMOJI_FAST = rf"{_KEYCAP}|(?={EMOJI_HINT})(?:{_FLAG}|{_SEQUENCE})"


def strip_ws(text: Column) -> Column:
    """Drop Unicode whitespace at both ends. A plain trim: it looks at the ends only."""
    return F.btrim(text, F.lit(WS_CHARS))


def is_blank(text: Column) -> Column:
    """No character but whitespace; stops at the first other one."""
    return ~text.rlike(NOT_WS)


def remove_urls(text: Column) -> Column:
    """Drop ``http`` and everything up to the next whitespace (lower case only)."""
    return F.regexp_replace(text, rf"http{NOT_WS}+", "")


def remove_mentions(text: Column) -> Column:
    return F.regexp_replace(text, rf"@{WORD}+", "")


def remove_hashtags(text: Column) -> Column:
    return F.regexp_replace(text, rf"#{WORD}+", "")


def remove_emojis(text: Column) -> Column:
    return F.when(text.rlike(EMOJI_HINT), F.regexp_replace(text, _EMOJI_FAST, "")).otherwise(text)


def strip_spaces(text: Column) -> Column:
    """Trim, and make every run of whitespace one space.

    Runs become a space first, so the trim only has spaces left to look at.
    """
    return F.trim(F.regexp_replace(text, rf"{WS}+", " "))


def to_lower(text: Column) -> Column:
    return F.lower(text)


def clean_text(
    text: Column,
    *,
    lower: bool = True,
    remove_url: bool = True,
    remove_user: bool = True,
    remove_hashtag: bool = True,
    remove_emoji: bool = True,
    strip_space: bool = True,
) -> Column:
    """All cleaning steps in their fixed order; a null text becomes the empty string."""
    out = text
    if remove_url:
        out = remove_urls(out)
    if remove_user and remove_hashtag:
        # Neither step can create a match for the other (what follows a removed tag is
        # never a word character), so one pass does both.
        out = F.regexp_replace(out, rf"[@#]{WORD}+", "")
    elif remove_user:
        out = remove_mentions(out)
    elif remove_hashtag:
        out = remove_hashtags(out)
    if remove_emoji:
        out = remove_emojis(out)
    if strip_space:
        out = strip_spaces(out)
    if lower:
        out = to_lower(out)
    return F.coalesce(out, F.lit(""))


def characters(text: Column) -> Column:
    """The distinct code points of a text."""
    return F.array_distinct(F.split(text, ""))


def drop_characters(text: Column, unwanted: Column) -> Column:
    """Delete every character of ``unwanted`` from ``text``."""
    return F.call_function("translate", text, unwanted, F.lit(""))

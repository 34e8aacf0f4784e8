"""Scalar functions over text columns, all built of JVM expressions."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .unicode import SPACE, chars, codepoint

#: Arabic-Indic and extended Arabic-Indic digits, in order; fixed values.
ARABIC_DIGITS = "٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹"


def codepoint_label(ch: Column) -> Column:
    """``U+`` and at least four hexadecimal digits."""
    return F.format_string("U+%04X", codepoint(ch))


#: General categories by the numbers that the JVM gives them; fixed values.
CATEGORIES = {
    0: "Cn", 1: "Lu", 2: "Ll", 3: "Lt", 4: "Lm", 5: "Lo", 6: "Mn", 7: "Me", 8: "Mc", 9: "Nd", 10: "Nl", 11: "No", 12: "Zs", 13: "Zl", 14: "Zp",
    15: "Cc", 16: "Cf", 18: "Co", 19: "Cs", 20: "Pd", 21: "Ps", 22: "Pe", 23: "Pc", 24: "Po", 25: "Sm", 26: "Sc", 27: "Sk", 28: "So", 29: "Pi", 30: "Pf",
}


def codepoint_category(ch: Column) -> Column:
    """General category of the first character, by the JVM's tables."""
    kinds = F.create_map(*(F.lit(x) for k, v in CATEGORIES.items() for x in (str(k), v)))
    return kinds[F.java_method(F.lit("java.lang.Character"), F.lit("getType"), codepoint(ch))]


def codepoint_name(ch: Column) -> Column:
    """Name of the first character, by the JVM's tables; null where it has none."""
    return F.java_method(F.lit("java.lang.Character"), F.lit("getName"), codepoint(ch))


def unicode_escape(text: Column) -> Column:
    r"""ASCII form: ``\t \n \r \\``, printable ASCII as it is, else ``\xhh``, ``\uhhhh`` or ``\Uhhhhhhhh``."""

    def one(c: Column) -> Column:
        cp = codepoint(c)
        return (
            F.when(c == "\t", "\\t").when(c == "\n", "\\n").when(c == "\r", "\\r").when(c == "\\", "\\\\")
            .when(cp.between(32, 126), c).when(cp < 256, F.format_string("\\x%02x", cp))
            .when(cp < 65536, F.format_string("\\u%04x", cp)).otherwise(F.format_string("\\U%08x", cp))
        )

    return F.array_join(F.transform(chars(text), one), "")


def normalize_text(text: Column) -> Column:
    """Controls to spaces, runs of white space to one space, trimmed; empty of null."""
    cleaned = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x00-\x1F\x7F]", " ")
    return F.btrim(F.regexp_replace(cleaned, f"[{SPACE}]+", " "), F.lit(" "))


def file_number(name: Column) -> Column:
    """Leading digits of a name, else its first digits, as a number of 38 digits at most; null without digits, and
    beyond that."""
    ascii_name = F.translate(name, ARABIC_DIGITS, "0123456789" * 2)
    digits = F.coalesce(*(F.nullif(F.regexp_extract(ascii_name, p, 1), F.lit("")) for p in (rf"^[{SPACE}]*([0-9]+)", "([0-9]+)")))
    return digits.try_cast("decimal(38,0)")


def identity_skeleton(text: Column) -> Column:
    """Text without marks, numerics and no-break spaces, its white space collapsed."""
    bare = F.regexp_replace(text, r"[\p{M}\p{N}\x{A0}]", "")
    return F.btrim(F.regexp_replace(bare, f"[{SPACE}]+", " "), F.lit(" "))


def escaped_context(text: Column, start: Column, stop: Column, radius: int = 14) -> Column:
    """Escaped text from ``radius`` characters before ``start`` (from 0) to as many after ``stop``."""
    first = F.greatest(F.lit(0), start - radius)
    return unicode_escape(F.substring(text, first + 1, F.least(F.length(text), stop + radius) - first))


def numbered_name(number: Column, name: Column) -> Column:
    return F.format_string("%03d - %s.docx", number, name)


def latin_name(text: Column) -> Column:
    """The first run of Latin letters, digits, spaces, apostrophes and hyphens that starts with a letter."""
    return F.btrim(F.regexp_extract(text, rf"[a-zA-Z][a-zA-Z0-9{SPACE}'-]*", 0))


def verse_number(verse_key: Column) -> Column:
    """The second part of ``chapter:verse``."""
    return F.split_part(verse_key, F.lit(":"), F.lit(2)).cast("int")


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    return F.regexp_replace(base_name(path), r"(?<=.)\.[^.]*$", "")


def suffix(path: Column) -> Column:
    """Last extension with its dot, in lower case; empty without one."""
    return F.lower(F.regexp_extract(base_name(path), r".(\.[^.]+)$", 1))


def compression_ratio(size: Column, compressed: Column) -> Column:
    return size / F.greatest(compressed, F.lit(1))


def rounded(value: Column, digits: int) -> Column:
    """To so many decimal places, ties to even."""
    return F.bround(value, digits)


def half_points(points: Column) -> Column:
    """Font size in half points, ties to even."""
    return F.bround(points * 2).cast("int")


def safe_member_name(name: Column) -> Column:
    """Whether a package member's name is relative, of forward slashes, and climbs nowhere."""
    bad = [name.isNull(), name == "", name.startswith("/"), name.contains("\\"), name.rlike(r"(^|/)\.\.(/|$)"), name.rlike(r"^[A-Za-z]:")]
    return ~F.coalesce(reduce(lambda a, b: a | b, bad), F.lit(True))


def is_safe_member_name(name: str | None) -> bool:
    """``safe_member_name`` of one name."""
    return bool(name) and re.search(r"^/|\\|(^|/)\.\.(/|$)|^[A-Za-z]:", name) is None


def font_signature(fonts: Column) -> Column:
    """``slot=font`` pairs by slot, comma-joined; ``(none)`` of an empty map."""
    pairs = F.transform(F.array_sort(F.map_entries(fonts)), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return F.when(F.size(fonts) > 0, F.array_join(pairs, ",")).otherwise("(none)")

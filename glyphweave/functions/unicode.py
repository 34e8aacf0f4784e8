"""Unicode classes as columns and regular-expression fragments.

``SPACE`` lists white space explicitly, as the classes of regular-expression engines disagree on it. General
categories are those of the JVM's Unicode tables; all engines agree within U+0600-06FF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space, for use inside a bracket expression; fixed values.
SPACE = r"\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
#: Arabic blocks; fixed values.
ARABIC_BLOCKS = ((0x0600, 0x06FF), (0x0750, 0x077F), (0x0870, 0x089F), (0x08A0, 0x08FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF))
#: Code points outside the blocks whose character names contain ARABIC; fixed values.
ARABIC_ELSEWHERE = ((0x206C, 0x206D), (0x10EC2, 0x10EC4), (0x10EFC, 0x10EFF), (0x1EE00, 0x1EEF1))
#: Arabic characters as a bracket expression.
ARABIC_CLASS = "[" + "".join(rf"\x{{{low:X}}}-\x{{{high:X}}}" for low, high in (*ARABIC_BLOCKS, *ARABIC_ELSEWHERE)) + "]"


def codepoint(ch: Column) -> Column:
    """Code point of the first character; 0 of an empty string."""
    return F.ascii(ch)


def is_space(ch: Column) -> Column:
    return ch.rlike(f"^[{SPACE}]")


def is_mark(ch: Column) -> Column:
    """General category M. ASCII is decided without the expression engine."""
    return (codepoint(ch) >= 0x300) & ch.rlike(r"^\p{M}")


def is_numeric(ch: Column) -> Column:
    """General category N. ASCII is decided without the expression engine."""
    cp = codepoint(ch)
    return cp.between(0x30, 0x39) | ((cp >= 0xB2) & ch.rlike(r"^\p{N}"))


def is_arabic(ch: Column) -> Column:
    cp = codepoint(ch)
    out = F.lit(False)
    for low, high in (*ARABIC_BLOCKS, *ARABIC_ELSEWHERE):
        out = out | cp.between(low, high)
    return out


def has_arabic(text: Column) -> Column:
    """Whether a text holds an Arabic character."""
    return text.rlike(ARABIC_CLASS)


def is_arabic_letter(ch: Column) -> Column:
    return is_arabic(ch) & ch.rlike(r"^[\p{Lo}\p{Lm}]")


def strip_marks(text: Column) -> Column:
    return F.regexp_replace(text, r"\p{M}", "")


def chars(text: Column) -> Column:
    """Characters (code points) of a text, as an array; none of an empty or null one."""
    return F.filter(F.split(text, ""), lambda c: c != "")

"""Names that differ in case, accents or blanks at their end only.

``collated`` puts a text under a collation of Spark, whose comparisons then hold in joins,
groups, windows and sorts, but which no hash join or hash aggregate takes. ``fold`` gives
the same classes of texts as plain text: it is built from generated expressions,
hashes, spreads a hot key like any text, and joins in the way of the optimizer's choice.
"""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Case, accents and blanks at the end do not count.
NAMES = "UNICODE_CI_AI_RTRIM"

#: Letters with a stroke or the like that have no decomposition, and those that count as two.
_STROKED = {"Đ": "D", "đ": "d", "Ð": "D", "ð": "d", "Ħ": "H", "ħ": "h", "L·": "L", "l·": "l", "Ł": "L", "ł": "l", "Ø": "O", "ø": "o", "Ґ": "Г", "ґ": "г"}
_DOUBLE = {"Æ": "AE", "Œ": "OE", "ẞ": "SS", "Ĳ": "IJ", "Ǆ": "DZ", "Ǳ": "DZ", "Ǉ": "LJ", "Ǌ": "NJ"}
#: A letter whose upper case is that of another one, and what no text holds in its place.
_DOTLESS = ("ı", "\uFDD0")
#: Letters that are not the letter they are written with.
_DISTINCT = "Йй"
#: Marks and invisible characters, but for those that part words.
_UNSEEN = r"[\p{M}\p{Cc}\p{Cf}&&[^\t-\r\x{85}]]"
_PLAIN = r"^[\x20-\x7E]*$"


def _plain_letter(c: str) -> str:
    """The letter without what is put on it; the same letter where there is none."""
    bare = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.category(x).startswith("M"))
    bare = _STROKED.get(bare, bare)
    blank = bare.isspace() and not c.isspace()
    if c == _DOTLESS[0]:
        return _DOTLESS[1]
    return bare if len(bare) == 1 and not blank and c not in _DISTINCT else c


@cache
def _letters() -> tuple[str, str]:
    """Letters to replace and what stands for them, one for one, from Unicode's decompositions."""
    found = [(chr(p), _plain_letter(chr(p))) for p in range(0x80, 0x3000) if unicodedata.category(chr(p))[0] in "LNZPS"]
    pairs = [(c, x) for c, x in found if c != x]
    return "".join(c for c, _ in pairs), "".join(x for _, x in pairs)


def fold(col: Column) -> Column:
    """A text that two texts share if they are equal under ``NAMES``; NULL stays NULL.

    Holds for Latin, Greek and Cyrillic letters in composed form. Printable ASCII, the
    usual case, is only trimmed and raised.
    """
    letters = F.translate(F.regexp_replace(col, _UNSEEN, ""), *_letters())
    upper = F.upper(letters)
    for letter, two in _DOUBLE.items():
        upper = F.replace(upper, F.lit(letter), F.lit(two))
    return F.rtrim(F.when(col.rlike(_PLAIN), F.upper(col)).otherwise(upper))


def collated(col: Column, collation: str | None) -> Column:
    """The text as keys are to compare it: as it is, folded under ``NAMES``, or under another collation of Spark."""
    if collation is None:
        return col
    return fold(col) if collation == NAMES else F.collate(col, collation)

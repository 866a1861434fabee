"""Problem 6: text that looks the same but differs in its characters.

``normalise`` brings a text to one form: compatibility composition of full-width and combining forms, plain
spaces, no default-ignorable characters, and look-alike letters of another script mapped into the script that
the word is written in. ``fold`` adds full case folding. Signs that look different from their plain spelling
(№, ², ½) stay: there, compatibility forms are applied to full-width forms only.

``key`` is what texts are compared by: it takes all compatibility forms, full case folding, and writes words wholly of
look-alikes in Latin letters.
"""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.shared import unused

#: Default-ignorable code points (fixed values of the Unicode property, the ones outside private use).
IGNORABLE = "\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b-\u180f\u200b-\u200f\u202a-\u202e\u2060-\u206f\u3164\ufe00-\ufe0f\ufeff\uffa0\ufff0-\ufff8"
#: Spaces other than the plain one.
SPACES = "\u00a0\u1680\u2000-\u200a\u202f\u205f\u3000"
#: Full-width forms.
WIDE = "\uff01-\uff5e\uffe0-\uffe6"

#: Look-alike letters: fixed values, one Cyrillic, Latin and Greek letter a row; '-' where there is none.
LOOKALIKES = """
А A Α
В B Β
Е E Ε
З - -
І I Ι
Ј J -
К K Κ
М M Μ
Н H Η
О O Ο
Р P Ρ
С C -
Ѕ S -
Т T Τ
У Y Υ
Х X Χ
- Z Ζ
- N Ν
а a α
е e ε
і i ι
ј j -
к - κ
о o ο
р p ρ
с c -
ѕ s -
у y -
х x χ
- v ν
п n -
т - τ
г r -
ё ë -
Ё Ë -
ї ï -
Ї Ï -
"""

SCRIPTS = {"CYRILLIC": 0, "LATIN": 1, "GREEK": 2}
_rows = [line.split() for line in LOOKALIKES.split("\n") if line]
#: MAP[a][b]: letters of script a to those of script b.
_MAP = [[{ord(r[a]): r[b] for r in _rows if r[a] != "-" and r[b] != "-" and a != b} for b in range(3)] for a in range(3)]

_DROP = re.compile(f"[{IGNORABLE}]")
_SPACE = re.compile(f"[{SPACES}]")
_WIDE = re.compile(f"[{WIDE}]+")
_MARKS = re.compile("[^\u0300-\u036f][\u0300-\u036f]+")
_ANY = re.compile(f"[{IGNORABLE}{SPACES}{WIDE}\u0300-\u036f]")
_CYR, _LAT, _GRK = "\u0400-\u052f", "A-Za-z\u00aa\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", "\u0370-\u0373\u0376\u0377\u037b-\u037d\u0386\u0388-\u03ff"
_MIXED = re.compile(f"[{_CYR}][{_LAT}{_GRK}]|[{_LAT}][{_CYR}{_GRK}]|[{_GRK}][{_CYR}{_LAT}]")
_RUN = re.compile(f"[{_CYR}{_LAT}{_GRK}\u00b5]+")
_OF = [re.compile(f"[{x}]") for x in (_CYR, _LAT, _GRK)]

#: Latin look-alikes of letters in one case. Cyrillic letters have them if they look alike in either case, for case folding
#: makes all cases equal; Greek ones if their small letters do. No two letters of a script have the same.
_LATIN = {ord(r[k].casefold()): r[1].casefold() for k in (0, 2) for r in _rows if "-" not in (r[k], r[1]) and (k == 0 or r[k].islower())}
_OURS = ["".join(chr(c) for c in _LATIN if p.match(chr(c))) for p in (_OF[0], _OF[2])]
_ALIKE = re.compile(f"(?:(?<![{_CYR}{_LAT}{_GRK}]){'(?:' + '|'.join(f'[{x}]+' for x in _OURS) + ')'})(?![{_CYR}{_LAT}{_GRK}])")

#: Any of these forms, for whole batches at once.
SIGNS = f"[{IGNORABLE}{SPACES}{WIDE}\u0300-\u036f]|{_MIXED.pattern}"

def one_script(word: str) -> str:
    """The word in the script that most of its letters which belong to one script only are of; as it stands if its
    letters can't all be written in one."""
    counts = [len(p.findall(word)) for p in _OF]
    if sum(map(bool, counts)) < 2:
        return word
    sure = [sum(not all(ord(c) in m for k, m in enumerate(_MAP[s]) if k != s and counts[k]) for c in _OF[s].findall(word)) for s in range(3)]
    for to in sorted(range(3), key=lambda s: (counts[s] == 0, -sure[s], -counts[s], s)):
        found = "".join(c if (s := next((k for k, p in enumerate(_OF) if p.match(c)), to)) == to else _MAP[s][to].get(ord(c), c) for c in word)
        if counts[to] and sum(bool(p.search(found)) for p in _OF) == 1:
            return found
    return word


def normalise(text: str | None) -> str | None:
    """One consistent spelling of ``text``; null stays null, the empty text stays empty. Line ends are kept."""
    if text is None:
        return None
    if _ANY.search(text):
        text = _DROP.sub("", text)
        text = _WIDE.sub(lambda m: unicodedata.normalize("NFKC", m[0]), text)
        text = _SPACE.sub(" ", text)
        text = _MARKS.sub(lambda m: unicodedata.normalize("NFC", m[0]), text)
    for _ in range(3):  # a letter that changes its script may compose with its mark then, and the other way round
        if not _MIXED.search(text):
            break
        before, text = text, _RUN.sub(lambda m: one_script(m[0]) if _MIXED.search(m[0]) else m[0], text)
        text = _MARKS.sub(lambda m: unicodedata.normalize("NFC", m[0]), text)
        if text == before:
            break
    return text


def fold(text: str | None) -> str | None:
    """``normalise`` with full case folding: texts that look alike compare as equal."""
    return None if text is None else normalise(text).casefold()


def key(text: str | None) -> str | None:
    """What ``text`` is compared by: equal for texts that look alike or differ in compatibility forms or case only.

    Compatibility composition and full case folding after ``normalise``, and words of which every letter has a Latin look-alike in
    Latin letters, until nothing changes. Null stays null.
    """
    if text is None:
        return None
    before, text = None, normalise(text)
    for _ in range(8):  # a letter that is written otherwise may compose with its mark then, or meet letters of another script
        if text == before:
            break
        before, text = text, normalise(unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold()))
        text = _ALIKE.sub(lambda m: m[0].translate(_LATIN), text)
    return text


def respelt(text: str | None) -> bool:
    """Whether ``text`` holds a form that problem 6 names: one that ``normalise`` changes, or a word of two scripts that it
    can't write in one."""
    return bool(text) and ((found := normalise(text)) != text or _MIXED.search(found) is not None)


def per_distinct(function, values: pa.Array, kind: pa.DataType) -> pa.Array:
    """``function`` of each distinct value, spread over the rows that have it; null for null."""
    coded = values.cast(pa.string()).dictionary_encode()
    return pa.array([function(v) for v in coded.dictionary.to_pylist()], type=kind).take(coded.indices)


def normalised(df: DataFrame, columns: list[str], folded: bool = False) -> DataFrame:
    """``df`` with the given text columns in one consistent spelling.

    Nulls stay null, empty texts stay empty; all other columns, whatever their names, are passed on untouched. One pattern
    over a whole batch tells which texts can hold such a form at all; each distinct value of these is worked on once.
    """

    @F.arrow_udf("string")
    def convert(values: pa.Array) -> pa.Array:
        odd = pc.fill_null(pc.match_substring_regex(values, SIGNS), False)
        found = pc.replace_with_mask(values.cast(pa.string()), odd, per_distinct(normalise, values.filter(odd), pa.string()))
        return per_distinct(str.casefold, found, pa.string()) if folded else found

    return df.withColumns({c: convert(F.col(f"`{c}`")) for c in columns})


def with_keys(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` with what each of the given text columns is compared by, in a column named as it and ``_key``."""

    @F.arrow_udf("string")
    def convert(values: pa.Array) -> pa.Array:
        return per_distinct(key, values, pa.string())

    return df.withColumns({unused(df, f"{c}_key"): convert(F.col(f"`{c}`")) for c in columns})

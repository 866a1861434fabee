"""Problem 4: text decoded with the wrong character encoding.

A field is split into passages (lines, and the sentences of a line). For every passage that can be garbled at all,
each chain of wrong decodings is undone, and every candidate is compressed with one zstandard dictionary a language.
A field of which nothing can be restored is told by replacement characters only: question marks in place of letters come
from writing a text in an encoding that lacks them, not from a wrong decoding.
The candidate of least description length, its chain's cost included, replaces the passage; if that is the passage as it
stands, it is left unchanged. The dictionaries are trained on a bounded, labelled sample (see ``train``).
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Texts a language that dictionaries are trained on, at most, and the characters of them together; the dictionary's bytes.
SAMPLE_TEXTS, SAMPLE_CHARS = 400, 4_000_000
DICTIONARY_BYTES = 96 * 1024
LEVEL = 12
#: Description length of a chain: bytes for naming it and bytes a step. No frame is shorter than so many bytes.
CHAIN_BYTES, STEP_BYTES, FRAME_BYTES = 1.0, 1.0, 9
#: Steps of a chain, at most.
DEPTH = 3


def _chars(codec: str) -> list[str]:
    """The character of each byte; bytes that the codec leaves undefined come as control characters."""
    out = []
    for b in range(256):
        try:
            out.append(bytes([b]).decode(codec))
        except UnicodeDecodeError:
            out.append(chr(b))
    return out


def _undefined(codec: str) -> list[int]:
    return [b for b in range(256) if not bytes([b]).decode(codec, "ignore")]


WRONG_FOR_UTF8 = ("cp1251", "cp1252", "latin-1", "koi8-r", "cp866")
#: (wrong codec, right codec) of single-byte confusions.
SINGLE = (("cp1252", "cp1251"), ("cp1251", "koi8-r"), ("koi8-r", "cp1251"), ("cp866", "cp1251"), ("cp1251", "cp866"), ("cp866", "koi8-r"), ("koi8-r", "cp866"), ("cp1252", "koi8-r"), ("cp1252", "cp866"))
#: Characters that plain text, or text garbled once, is written with; a decoding that yields others is none.
_PLAUSIBLE = "".join(bytes([b]).decode(c, "ignore") for c in ("cp1251", "cp1252", "latin-1", "koi8-r", "cp866") for b in range(128, 256))
_IMPLAUSIBLE = re.compile(f"[^\\x00-\\x7f{re.escape(_PLAUSIBLE)}\u0300-\u0304\u0306-\u0308\u030a-\u030c\u0327\u0328\u0370-\u03ff\u2000-\u206f\u2190-\u2193\u3000\ufeff\uff01-\uff5e]")


#: For measuring, spaces of any kind are plain and invisible characters absent: they are problem 6, not this one.
_PLAIN = {ord(c): " " for c in "\u00a0\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"} | dict.fromkeys(map(ord, "\u00ad\u200b\u200c\u200d\u2060\ufeff"))
_CYRILLIC = re.compile("[Ѐ-ӿ]")
_ABOVE = re.compile("[^\\W\\d_\\x00-\\x7f]")


class Utf8As:
    """Undoes UTF-8 that was read as a single-byte encoding, wherever the characters form valid sequences.

    ``lost`` is the byte that a replacement character stands for, if the reader put one.
    """

    def __init__(self, codec: str, lost: int | None = None):
        self.name = f"utf-8 as {codec}" + (f", {lost:#x} lost" if lost else "")
        chars = _chars(codec)
        self.byte = {c: b for b, c in enumerate(chars) if b >= 128}
        for b in range(128, 160):  # controls stand for themselves where a decoder passed them on
            self.byte.setdefault(chr(b), b)
        if lost:
            self.byte["�"] = lost
        of = lambda lo, hi: "[" + "".join(re.escape(c) for c, b in self.byte.items() if lo <= b <= hi) + "]"
        tail = of(0x80, 0xBF)
        self.one = re.compile(f"{of(0xC2, 0xDF)}{tail}|{of(0xE0, 0xEF)}{tail}{{2}}|{of(0xF0, 0xF4)}{tail}{{3}}")
        self.regex = re.compile(f"(?:{self.one.pattern})+")

    def undo(self, text: str) -> str:
        """Where most letters beyond ASCII lie in valid sequences, all of these are decoded; else only long runs, signs and
        what is of another script, as a letter wrong by itself among sound ones of its script comes from no decoding."""
        inside = 0
        for m in self.regex.finditer(text):
            inside += len(_ABOVE.findall(m[0]))
        outside = len(_ABOVE.findall(text)) - inside
        every = inside >= outside

        def decode(m: re.Match) -> str:
            try:
                found = bytes(self.byte[c] for c in m[0]).decode("utf-8")
            except UnicodeDecodeError:
                return m[0]
            alone = not every and len(found) < 3 and any(map(str.isalpha, found)) and _CYRILLIC.search(m[0])
            if alone or _IMPLAUSIBLE.search(found):
                return m[0]
            return found

        return self.regex.sub(decode, text)


class SingleAs:
    """Undoes a single-byte encoding that was read as another one.

    Such a reader gives nothing but its own characters: a passage that holds others comes from no such reading. Spaces,
    invisible characters and marks that were put in afterwards don't count.
    """

    def __init__(self, wrong: str, right: str):
        self.name = f"{right} as {wrong}"
        table = {w: r for w, r, b in zip(_chars(wrong), _chars(right), range(256)) if b >= 128 and w != r}
        if wrong == "cp1252":
            table |= {chr(b): _chars(right)[b] for b in range(128, 160)}
        self.table = str.maketrans(table)
        own = "".join(re.escape(c) for c in _chars(wrong)[128:])
        self.foreign = re.compile(f"[^\\x00-\\x9f{own}{''.join(map(chr, _PLAIN))}\u0300-\u036f]")

    def undo(self, text: str) -> str:
        return text if self.foreign.search(text) else text.translate(self.table)


#: Signs of damage, as one class of characters that plain text of the languages does without and a few sequences of
#: plain ones. A text without any of them is the same under every chain, or can't get shorter.
RARE = "\u0080-\u009f�─-▟∙√⌠⌡ЀЂ-ЅЇ-ЍЏѐђ-ѕї-ѝџҐґ¡-¦¨ª¬®-±´µ¶¸-º¼-ÃÅ-ÕØ-ÛÝÞà-ãå-õø-ûýþÿŒœŠšŸŽžƒˆ˜†‡‰‹›€™"
SIGNS = f"[{RARE}]|тА|В[«»°©·ІЎ]|\\?\\?|[А-ЯЁ]{{4}}|[ÄÖÜäöüß§]{{3}}"
_SIGNS, _RARE = re.compile(SIGNS), re.compile(f"[{RARE}]")
_LATIN = re.compile("[À-ÿŒœŠšŸŽžƒ]{2}|[\u0080-\u009f¹º]")
_BOXES = re.compile("[─-▟∙√⌠⌡ЇїЄє°·№¤]")
_CAPITALS = re.compile("[А-ЯЁA-Z]{3}")
_SWAPPED = re.compile("[А-ЯЁ]{2}")
_DOS = re.compile("[ЂЃѓ†‡€‰ЉЊЌЋЏђ™љ›њќћџЎўЈ¤Ґ¦§©Є¬®Ї­«]")
#: The steps, each with what a passage must hold for it to make sense.
STEPS = [(s, s.one) for s in map(Utf8As, WRONG_FOR_UTF8)] + [(SingleAs(w, r), {"cp1252": _LATIN, "cp866": _BOXES, "koi8-r": _SWAPPED}.get(w) or (_DOS if r == "cp866" else _SWAPPED)) for w, r in SINGLE]
#: A reader of UTF-8 as cp1251 puts a replacement character for the byte that cp1251 leaves undefined, or for a space that
#: doesn't break: both are tried where there is one.
STEPS += [(Utf8As("cp1251", b), re.compile("�")) for b in (*_undefined("cp1251"), 0xA0)]
_SENTENCE = re.compile(r"(?<=[.!?;:,])\s+")


@dataclass
class Repairer:
    """Restores passages; ``dictionaries`` has the bytes of a zstandard dictionary for each language."""

    dictionaries: dict[str, bytes]
    _packers: list = field(default_factory=list)
    _known: dict = field(default_factory=dict)
    _done: dict = field(default_factory=dict)

    def __getstate__(self) -> dict:
        return {"dictionaries": self.dictionaries, "_packers": [], "_known": {}, "_done": {}}

    def length(self, text: str) -> int:
        """Bytes of the shortest description of ``text`` over the languages, and one for each character beyond their
        alphabets, which takes an escape."""
        if not self._packers:
            for raw in self.dictionaries.values():
                d = zstandard.ZstdCompressionDict(raw)
                d.precompute_compress(level=LEVEL)
                self._packers.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_dict_id=False, write_checksum=False))
        if (known := self._known.get(text)) is None:
            plain = text.translate(_PLAIN)
            data = plain.encode("utf-8", "surrogatepass")
            if _CAPITALS.search(text) and text.isupper():  # a flag and the text in small letters
                data = plain.lower().encode("utf-8", "surrogatepass") + b"^"
            known = min((len(p.compress(data)) for p in self._packers), default=len(data)) + len(_RARE.findall(plain))
            if len(self._known) > 20_000:
                self._known.clear()
            self._known[text] = known
        return known

    def passage(self, text: str) -> str:
        """The passage with the chain undone that makes it shortest to describe.

        A chain has up to ``DEPTH`` steps, of which no two single-byte confusions follow one another. All chains are
        followed; a candidate is compressed unless its characters beyond the alphabets alone make it too long.
        """
        if (known := self._done.get(text)) is not None:
            return known
        best, least = text, self.length(text)
        seen, front = {text}, [(text, True)]
        for depth in range(1, DEPTH + 1):
            after, toll = [], CHAIN_BYTES + depth * STEP_BYTES
            for base, single in front:
                for step, needs in STEPS:
                    utf8 = isinstance(step, Utf8As)
                    if not (utf8 or single) or not needs.search(base) or (found := step.undo(base)) in seen:
                        continue
                    seen.add(found)
                    after.append((found, utf8))
                    if FRAME_BYTES + toll + len(_RARE.findall(found)) < least and (cost := self.length(found) + toll) < least:
                        best, least = found, cost
            front = after
        if len(self._done) > 20_000:
            self._done.clear()
        self._done[text] = best
        return best

    def restore(self, text: str | None) -> tuple[str | None, bool]:
        """The text with its passages restored, and whether any passage was decoded wrongly."""
        if not text or not _SIGNS.search(text):
            return text, False
        found, out = False, []
        for line in text.split("\n"):
            if _SIGNS.search(line):
                best = self.passage(line)
                if _SIGNS.search(best) and " " in best:
                    parts, pos = [], 0
                    for m in [*_SENTENCE.finditer(best), None]:
                        end = m.start() if m else len(best)
                        piece = best[pos:end]
                        parts.append((self.passage(piece) if _SIGNS.search(piece) else piece) + (m[0] if m else ""))
                        pos = m.end() if m else end
                    best = "".join(parts)
                if best != line:
                    found, line = True, best
                found = found or "�" in line  # nothing restores what a decoder gave up
            out.append(line)
        return "\n".join(out), found


def train(labelled: DataFrame, text: str = "text", language: str = "lang", key: str = "doc_id", per_language: int = SAMPLE_TEXTS, chars: int = SAMPLE_CHARS) -> Repairer:
    """Dictionaries of the languages of ``labelled``, from at most ``per_language`` whole texts and ``chars`` characters of
    each.

    The sample is the rows of least hashed key among those with a language, so it is the same at every run; it is the
    only thing of the table that reaches the driver. Rows without language or text, and texts longer than ``chars``, are
    not used.
    """
    order = Window.partitionBy(language).orderBy("_h", key)
    size = F.length(text)
    keys = labelled.where(F.col(language).isNotNull() & size.between(1, chars)).select(language, key, F.xxhash64(key).alias("_h"), size.alias("_size"))
    chosen = keys.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= per_language)
    chosen = chosen.withColumn("_sum", F.sum("_size").over(order.rowsBetween(Window.unboundedPreceding, 0))).where(F.col("_sum") <= chars).select(language, key)
    texts: dict[str, list[bytes]] = {}
    for row in labelled.join(F.broadcast(chosen), [language, key], "left_semi").select(language, text).collect():
        texts.setdefault(row[0], []).extend(p.encode() for p in row[1].split("\n") if p.strip())
    return Repairer({k: dictionary(v) for k, v in sorted(texts.items())})


def dictionary(samples: list[bytes]) -> bytes:
    """A zstandard dictionary of the samples; raw content where they are too few to train on."""
    samples = sorted(set(samples))
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=1024, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(samples)[-DICTIONARY_BYTES:] or b"\n" * 8

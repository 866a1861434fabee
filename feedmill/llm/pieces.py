"""Problem 10: splitting oversized items at natural boundaries.

A text's boundaries are the ends of paragraphs, lines, sentences, clauses and words. A dynamic programme over all of
them chooses the cuts of least cost: what a cut at such a boundary costs, plus how far the pieces' sizes lie from even
ones, under the capacity and with the overlap. Cuts and overlaps lie between the words that the tokenizer sees, so a
piece counted by itself has just as many tokens as in its text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.llm import tokens

#: What a cut costs after a paragraph, a line, a sentence, a clause, a word and inside one; what a piece and unevenness cost.
PARAGRAPH, LINE, SENTENCE, CLAUSE, WORD, INSIDE = 0.0, 0.1, 0.3, 0.8, 1.5, 4.0
PIECE, UNEVEN = 1.0, 1.0
#: Characters of a word after which it is cut into parts of that many: no word is longer than a piece then.
LONGEST_WORD = 64

_WORDS = regex.compile(tokens.PATTERN)
_BREAKS = (
    (SENTENCE, re.compile(r"[.!?…][»”\"')\]]*(?=\s)")),
    (CLAUSE, re.compile(r"[,;:](?=\s)|\s(?=[–—]\s)")),
    (LINE, re.compile(r"\r\n?|[\n \v\f\u0085]")),
    (PARAGRAPH, re.compile(r"(?:\r\n?|\n)[^\S\n\r]*(?:\r\n?|\n)\s*| |\n(?=\s*(?:#{1,6} |[-*•] |\d+[.)] ))")),
)


class _Counts(dict):
    """Tokens of a word; filled from the tokenizer."""

    def __init__(self, folder: str, vocabulary: str):
        super().__init__()
        self.encoding = tokens.encoding(folder, vocabulary)

    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        self[word] = n = len(self.encoding.encode_ordinary(word))
        return n


def split_words(text: str, counts: _Counts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Character and token offsets of the words that the tokenizer sees, ends included, and where a word was cut."""
    words = _WORDS.findall(text)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    if len(words) and lengths.max() > LONGEST_WORD:
        cut, parts = [], []
        for w in words:
            for k in range(0, len(w), LONGEST_WORD):
                parts.append(w[k : k + LONGEST_WORD])
                cut.append(k > 0)
        words, inside = parts, np.array([*cut, False])
        lengths = np.fromiter(map(len, words), np.int64, len(words))
    else:
        inside = np.zeros(len(words) + 1, bool)
    chars = np.concatenate(([0], np.cumsum(lengths)))
    sizes = np.concatenate(([0], np.cumsum(np.fromiter(map(counts.__getitem__, words), np.int64, len(words)))))
    return chars, sizes, inside


def costs(text: str, chars: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """What a cut before each word costs."""
    out = np.where(inside, INSIDE, WORD)
    for cost, pattern in _BREAKS:
        if len(ends := np.array([m.end() for m in pattern.finditer(text)], np.int64)):
            at = np.searchsorted(chars, ends)
            at = at[(at > 0) & (at < len(chars) - 1)]
            out[at] = np.minimum(out[at], cost)
    return out


def _cheapest(tok: list[float], begin: list[float], price: list[float], capacity: int, even: float) -> tuple[float, list[int]]:
    """Least cost of all ways from the first boundary to the last, and the boundary before each on the cheapest way.

    Of two boundaries to begin a piece from, the later one is the better from some end on and stays so: the cost of
    unevenness is convex in the size, and the earlier one is the first that the capacity rules out. So it is enough to
    keep those that are best somewhere ahead, with the token from which each is.
    """
    m, square = len(tok), even * even / UNEVEN
    back = [0] * m
    # of each kept boundary: itself, tok + even, its cost's constant term, the last end within capacity, from where it is best
    kept, middle, term, last, since = [0], [tok[0] + even], [(tok[0] + even) ** 2], [begin[0] + capacity], [-1.0]
    head, least = 0, np.inf
    for i in range(1, m):
        t = tok[i]
        while head + 1 < len(kept) and since[head + 1] <= t:
            head += 1
        if last[head] < t:  # no piece that ends here is small enough
            least = np.inf
            continue
        back[i] = kept[head]
        least = (t * (t - 2 * middle[head]) + term[head]) / square + price[i] + PIECE
        u = t + even
        h = least * square + u * u
        while True:
            x = (h - term[-1]) / (2 * (u - middle[-1]))
            if x > last[-1]:
                x = last[-1] + 0.5
            if x > since[-1] or len(kept) - 1 == head:
                break
            kept.pop(), middle.pop(), term.pop(), last.pop(), since.pop()
        kept.append(i), middle.append(u), term.append(h), last.append(begin[i] + capacity), since.append(x)
    return least, back


def cuts(sizes: np.ndarray, cost: np.ndarray, capacity: int, overlap: int) -> list[tuple[int, int]]:
    """Pieces as (first word, end word): the cheapest way to cover all words within ``capacity``.

    Every piece but the first begins at the last word boundary that gives at least ``overlap`` tokens of the one before.
    """
    total = int(sizes[-1])
    n = len(sizes) - 1
    pieces = max(2, -(-(total - overlap) // (capacity - overlap)))
    even = (total - overlap) / pieces
    # where a piece that follows a cut at each boundary begins
    start = np.maximum(np.searchsorted(sizes, sizes - overlap, side="right") - 1, 0)
    # no way costs less than as many even pieces as must be, or as are cheapest, with cuts of the least price
    fewest = max(pieces, total / even / 2**0.5)
    bound = fewest * PIECE + UNEVEN * (total - fewest * even) ** 2 / (fewest * even**2) + (pieces - 2) * float(cost[1:n].min(initial=INSIDE))
    # ends of sentences and better boundaries first: their way is the cheapest of all if one cut at a finer boundary takes
    # any other above its cost; else all boundaries are looked at
    for worst, finer in ((SENTENCE, CLAUSE), (CLAUSE, WORD), (INSIDE, np.inf)):
        at = np.concatenate(([0], np.flatnonzero(cost[1:n] <= worst) + 1, [n]))
        price = cost[at]
        price[-1] = 0.0
        least, back = _cheapest(sizes[at].tolist(), sizes[start[at]].tolist(), price.tolist(), capacity, even)
        if least <= bound + finer:
            break
    out, i = [], len(at) - 1
    while i > 0:
        j = back[i]
        out.append((int(start[at[j]]), int(at[i])))
        i = j
    return out[::-1]


def pieces_of(text: str, limits: list[tuple[str, int, int]], counts: _Counts) -> list[tuple]:
    """(limit name, piece number, pieces, from character, to character, tokens, shared tokens, text) for each limit the
    text exceeds."""
    chars, sizes, inside = split_words(text, counts)
    out, cost = [], None
    for name, capacity, overlap in limits:
        if sizes[-1] <= capacity:
            continue
        cost = costs(text, chars, inside) if cost is None else cost
        found = cuts(sizes, cost, capacity, overlap)
        ended = 0
        for k, (a, b) in enumerate(found, 1):
            shared = int(sizes[ended] - sizes[a]) if k > 1 else 0
            out.append((name, k, len(found), int(chars[a]), int(chars[b]), int(sizes[b] - sizes[a]), shared, text[chars[a] : chars[b]]))
            ended = b
    return out


def split(df: DataFrame, limits: list[tuple[str, int, int]], item: str = "doc_id", text: str = "text", folder: str = tokens.FOLDER, vocabulary: str = tokens.VOCABULARY) -> DataFrame:
    """(item, limit_name, piece_no, n_pieces, char_from, char_to, n_tokens, shared_tokens, piece) of every text that
    exceeds a limit (name, capacity, overlap).

    Characters are counted from 0, the end excluded. Pieces follow one another without gaps; each but the first begins
    with the last ``shared_tokens`` of the one before, the overlap or as many more as end at a word. Null and empty texts
    and texts within a limit have no pieces for it. Capacity must exceed the overlap by two longest words at least.
    """
    limits = [(n, c, o or 0) for n, c, o in limits]
    for name, capacity, overlap in limits:
        if capacity - overlap < 4 * LONGEST_WORD // 2 or overlap < 0:
            raise ValueError(f"{name}: the overlap leaves no room in the capacity")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts(folder, vocabulary)
        kinds = (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        names = ["item", "limit_name", "piece_no", "n_pieces", "char_from", "char_to", "n_tokens", "shared_tokens", "piece"]
        for batch in batches:
            rows = []
            for key, t in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist()):
                rows += [(key, *p) for p in pieces_of(t, limits, counts)]
                if len(rows) > 2000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    schema = "item long, limit_name string, piece_no int, n_pieces int, char_from long, char_to long, n_tokens long, shared_tokens long, piece string"
    # a text has at most as many tokens as bytes: shorter ones exceed no limit
    least = min((c for _, c, _ in limits), default=0)
    rows = df.select(F.col(item).cast("long").alias("item"), F.col(text).alias("text")).where(F.octet_length("text") > least)
    return rows.mapInArrow(cut, schema).withColumnRenamed("item", item)

"""Benchmark decontamination with one Aho-Corasick automaton.

Texts are normalised bytewise: A-Z lower-cased, words are runs of
``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``, words joined by one space. Every run of
``window`` consecutive words of a benchmark item is a pattern (a shorter item
is one pattern whole). The words of the benchmark are numbered, and a number
is one character of the automaton: a window takes as many states as it has
words. The automaton scans each normalised document once, as the numbers of
its words; a match's end is its last word, and words map back to character
spans of the original text.

The benchmark is held by every worker, so its size is checked: items are
dealt into blocks of ``block_bytes`` of text on average, and further blocks
scan the documents again, with what was found so far written to the shared
folder between them. Memory follows one block (about 80 MB of a worker for
each MB of text, so some 330 MB), whatever the benchmark's size; only an item
longer than a block makes a larger one.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import materialise, text_bytes, without

#: A-Z to lower case; bytes outside words to spaces; the rest unchanged.
NORMAL = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A
               or c >= 0x80 else 0x20 for c in range(256))
ORIGINAL_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")

#: Words that have a character of their own: all but NUL (a word that no item
#: has) and the surrogates. More words than these take two characters each.
CHARACTERS = 0x10FFFF - 0x800
UNKNOWN = "\0"

_AUTOMATA: dict[str, tuple] = {}


def words_of(text: str | None) -> list[bytes]:
    # a lone surrogate cannot occur in a Spark string
    return (text or "").encode().translate(NORMAL).split()


def character(number: int) -> str:
    """The ``number``-th character (from 0) after NUL that is no surrogate."""
    return chr(number + 1 if number + 1 < 0xD800 else number + 0x801)


class Windows:
    """One automaton over the word numbers of all windows of a block."""

    def __init__(self, items: list[tuple], window: int, characters: int = CHARACTERS):
        numbers: dict[bytes, int] = {}
        coded = [(item, [numbers.setdefault(w, len(numbers)) for w in words_of(text)])
                 for item, text in items]
        self.width = 1 if len(numbers) <= characters else 2
        if self.width == 1:
            letters = [character(i) for i in range(len(numbers))]
        else:
            # first and second characters differ in kind, so matches start at words
            half = CHARACTERS // 2
            letters = [character(i // half) + character(half + i % half)
                       for i in range(len(numbers))]
        self.letters = dict(zip(numbers, letters, strict=True))
        self.unknown = UNKNOWN * self.width
        self.automaton = ahocorasick.Automaton()
        for item, words in coded:
            spelt = [letters[i] for i in words]
            for i in range(max(1, len(spelt) - window + 1) if spelt else 0):
                p = "".join(spelt[i:i + window])
                held = self.automaton.get(p, None)
                if held is None:            # number of words, then the items
                    self.automaton.add_word(p, [min(len(spelt), window), item])
                elif held[-1] != item:      # equal ids follow each other
                    held.append(item)
        if numbers:
            self.automaton.make_automaton()

    def hits(self, words: list[bytes]) -> Iterator[tuple[int, list]]:
        """(number of the word after the window, [words of the window, items])
        of every occurrence."""
        if self.letters:
            get, unknown = self.letters.get, self.unknown
            spelt = "".join(map(get, words, itertools.repeat(unknown)))
            for last, held in self.automaton.iter(spelt):
                yield (last + 1) // self.width, held


def scan(windows: Windows, text: str | None) -> tuple[int, list[tuple[int, int]], set]:
    """(words, merged spans of hit words as [first, last + 1), items found)."""
    words = words_of(text)
    items: set = set()
    spans: list[tuple[int, int]] = []
    for stop, held in windows.hits(words):
        items.update(held[1:])
        spans.append((stop - held[0], stop))
    return len(words), merge(spans), items


def merge(spans) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def original_spans(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Character spans in ``text`` of word spans (words of the original text
    and of its normal form correspond one to one)."""
    at = [m.span() for m in ORIGINAL_WORD.finditer(text)]
    return [(at[a][0], at[b - 1][1]) for a, b in spans]


def find_hits(docs: DataFrame, benchmark: DataFrame, window: int = 10,
              block_bytes: int = 4 << 20, text_col: str = "text",
              item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with ``n_words`` (long), ``hit_words``
    (spans of words inside any occurring window, as [start, stop)),
    ``hit_chars`` (the same in characters of the original text) and ``items``
    (ids whose windows occur, sorted; ids may be of any type that sorts). Input
    columns of these names are replaced. A null or empty text has no words and no hits; benchmark rows
    with a null id or without words match nothing; an item id that repeats
    counts once; with an empty benchmark nothing is hit. Texts of any length
    are scanned whole; ids play no part, so rows may repeat."""
    out = without(docs, "n_words", "hit_words", "hit_chars", "items")
    items = (benchmark.select(F.col(item_id).alias("id"), F.col(item_text).alias("t"))
             .filter("id is not null and t is not null"))
    blocks = max(1, -(-text_bytes(items, "t") // block_bytes))
    spans = "array<struct<start:long,stop:long>>"
    item = items.schema["id"].dataType.simpleString()
    found = f"n_words long, hit_words {spans}, hit_chars {spans}, items array<{item}>"
    for block in range(blocks):
        part = items if blocks == 1 else items.filter(
            F.pmod(F.xxhash64("id", "t"), F.lit(blocks)) == block)
        table = part.toArrow()
        held = sorted(set(zip(*(c.to_pylist() for c in table.columns), strict=True)))
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema.fields
                           if f.name not in ("n_words", "hit_words", "hit_chars", "items"))
        if block:
            out = materialise(out, "decontaminate")
        out = out.mapInArrow(_scan_batches(held, table.schema.field("id").type, window, text_col,
                                           not block), f"{fields}, {found}")
    return out


def _scan_batches(held: list[tuple], item_type: pa.DataType, window: int, text_col: str,
                  first: bool):
    key = f"{window}:{hash(tuple(held))}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _AUTOMATA:
            _AUTOMATA.clear()               # one block's automaton at a time
            _AUTOMATA[key] = (Windows(held, window),)
        windows = _AUTOMATA[key][0]
        span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        for batch in batches:
            names = batch.schema.names
            n_words, words, chars, items = [], [], [], []
            earlier = (itertools.repeat((None, None)) if first else
                       zip(batch.column(names.index("hit_words")).to_pylist(),
                           batch.column(names.index("items")).to_pylist(), strict=True))
            for value, (before, ids) in zip(batch.column(names.index(text_col)), earlier):
                text = value.as_py()
                n, spans, got = scan(windows, text)
                if before:
                    spans = merge(spans + [(s["start"], s["stop"]) for s in before])
                    got |= set(ids)
                n_words.append(n)
                words.append([{"start": a, "stop": b} for a, b in spans])
                chars.append([{"start": a, "stop": b} for a, b in original_spans(text, spans)]
                             if spans else [])
                items.append(sorted(got))
            kept = len(names) if first else len(names) - 4
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:kept], pa.array(n_words, pa.int64()), pa.array(words, span),
                 pa.array(chars, span), pa.array(items, pa.list_(item_type))],
                names=[*names[:kept], "n_words", "hit_words", "hit_chars", "items"])

    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                      **kw) -> DataFrame:
    """The rows of ``docs`` without any hit word, columns unchanged, whatever
    their names."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    marked = find_hits(docs.toDF(*names), benchmark,
                       text_col=names[docs.columns.index(text_col)], **kw)
    return marked.filter(F.size("hit_words") == 0).select(*names).toDF(*docs.columns)

"""Token counts by finite-state transducers compiled from a tokenizer file.

Two deterministic transducers in a row give the counts of a BPE tokenizer
with word ends (lower-cased text, white space dropped):

* the word splitter, over character classes: 7 states, transitions marked
  with the word starts that they emit. Texts are cut into chunks anywhere;
  a chunk's map takes each state on entry to the state on exit; maps compose,
  so a parallel prefix scan (log steps) gives every chunk its entry state,
  whatever the length of a text;
* the word encoder, over bytes: a state holds, for the last few positions
  (as many as a vocabulary entry can still reach back over), the last token
  of the encoding up to there and its relative token count. A transition is
  marked with the change of the token count. It rests on two facts of BPE:
  the encoding of a text without its last token is the encoding of the
  shorter text, and tokens stand side by side in an encoding exactly if
  encoding the two together gives the two. States are built when first met
  and the tables are dropped when they reach a fixed size.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lodestar.llm.common import without

SPACE, NUMBER, OTHER, APOSTROPHE, LETTER, ENDS, R, V, L, E = range(10)
START, IN_LETTERS, IN_OTHER, APOS, APOS_R, APOS_V, APOS_L = range(7)
HERE, BEFORE = 1, 2                   # a word starts at this / the previous character


def splitter_tables() -> tuple[np.ndarray, np.ndarray]:
    """(next state, emitted starts) by state and class, for words that are an
    apostrophe with s, t, m, d, re, ve or ll, letter runs, single numbers, or
    runs of anything else but white space."""
    go, out = np.zeros((7, 10), np.uint8), np.zeros((7, 10), np.uint8)
    for state in range(7):
        for c in range(10):
            letter = c >= LETTER
            go[state, c] = (START if c in (SPACE, NUMBER) else IN_OTHER if c == OTHER
                            else APOS if c == APOSTROPHE else IN_LETTERS)
            out[state, c] = 0 if c == SPACE else HERE
            if state == IN_LETTERS and letter:
                out[state, c] = 0
            elif state in (IN_OTHER, APOS) and c in (OTHER, APOSTROPHE):
                go[state, c], out[state, c] = IN_OTHER, 0
            elif state == APOS and c == ENDS:
                go[state, c], out[state, c] = START, 0
            elif state == APOS and c in (R, V, L):
                go[state, c], out[state, c] = {R: APOS_R, V: APOS_V, L: APOS_L}[c], 0
            elif state >= APOS_R:
                if c == (L if state == APOS_L else E):
                    go[state, c], out[state, c] = START, 0
                else:                   # no contraction: the letter before began a word
                    out[state, c] = BEFORE | (0 if letter else out[state, c])
    return go, out


GO, OUT = splitter_tables()


def word_starts(classes: np.ndarray, chunk: int = 128) -> np.ndarray:
    """Flags of the characters at which words start. ``classes`` must end in
    white space."""
    n = len(classes)
    cut = np.full(-(-n // chunk) * chunk, SPACE, np.uint8)
    cut[:n] = classes
    cut = np.ascontiguousarray(cut.reshape(-1, chunk).T)       # position x chunk
    go = GO.reshape(-1)
    # map of each chunk: state on entry -> state on exit
    exits = np.repeat(np.arange(7, dtype=np.uint8)[:, None], cut.shape[1], axis=1)
    for column in cut:
        exits = go[exits * np.uint8(10) + column]
    # inclusive prefix scan of the maps under composition
    step = 1
    while step < cut.shape[1]:
        exits[:, step:] = np.take_along_axis(exits[:, step:], exits[:, :-step], axis=0)
        step *= 2
    state = np.concatenate([[START], exits[START, :-1]]).astype(np.uint8)
    emitted = np.empty_like(cut)
    flat = OUT.reshape(-1)
    for i, column in enumerate(cut):
        at = state * np.uint8(10) + column
        emitted[i], state = flat[at], go[at]
    emitted = emitted.T.reshape(-1)[:n]
    starts = (emitted & HERE).astype(bool)
    starts[:-1] |= (emitted[1:] & BEFORE).astype(bool)
    return starts


class WordEncoder:
    """Token count of a word, by the lazily built transducer over its bytes."""

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str, max_states: int = 60_000):
        byte_of = byte_characters()
        self.max_states = max_states
        ranked: dict[tuple[bytes, bool], int] = {}

        def entry(token: str) -> tuple[bytes, bool]:
            last = token.endswith(suffix) and token != suffix
            token = token[:-len(suffix)] if last else token
            return bytes(byte_of[c] for c in token), last

        for b in range(256):
            ranked[bytes([b]), False], ranked[bytes([b]), True] = 2 * b, 2 * b + 1
        self.parts: list[tuple[int, int]] = [(i, i) for i in range(512)]
        self.joined: dict[tuple[int, int], int] = {}
        for left, right in merges:
            (a, _), (b, last) = entry(left), entry(right)
            if (a + b, last) not in ranked:
                pair = ranked[a, False], ranked[b, last]
                self.joined[pair] = ranked[a + b, last] = len(self.parts)
                self.parts.append(pair)
        self.inner = {t: i for (t, last), i in ranked.items() if not last}
        self.final = {t: i for (t, last), i in ranked.items() if last}
        self.reach = {t[:i] for t, _ in ranked for i in range(len(t) + 1)}
        self.side_by_side: dict[tuple[int, int], bool] = {}
        self.clear()

    def clear(self) -> None:
        """Only the state of an empty word."""
        self.ids: dict[tuple, int] = {}
        self.keys: list[tuple] = []
        self.go: list[dict[int, tuple[int, int]]] = []
        self.end: list[dict[int, int]] = []
        self.state((b"", ((-1, 0),)))

    def state(self, key: tuple) -> int:
        if key not in self.ids:
            self.ids[key] = len(self.keys)
            self.keys.append(key)
            self.go.append({})
            self.end.append({})
        return self.ids[key]

    def stand(self, a: int, b: int) -> bool:
        """Whether tokens a, b encode as themselves side by side: undo merges
        on either side of the seam, latest first; if a merge across the seam
        comes before the one undone, it would have happened instead."""
        known = self.side_by_side.get((a, b))
        if known is None:
            known, left, right, bound = True, a, b, len(self.parts)
            while True:
                across = self.joined.get((left, right))
                if across is not None and across < bound:
                    known = False
                    break
                if left < 512 and right < 512:
                    break
                if left > right:        # of equal tokens the left one merges first
                    bound, left = left, self.parts[left][1]
                else:
                    bound, right = right + 1, self.parts[right][0]
            if len(self.side_by_side) > 1_000_000:
                self.side_by_side.clear()
            self.side_by_side[a, b] = known
        return known

    def step(self, state: int, byte: int, tokens: dict[bytes, int]) -> tuple[bytes, tuple, int]:
        """(reach, window before it, last token, count change) after a byte."""
        back, window = self.keys[state]
        back += bytes([byte])
        while back not in self.reach:
            back = back[1:]
        for size in range(len(back), 0, -1):
            token = tokens.get(back[-size:])
            if token is not None:
                before, count = window[-size]
                if before < 0 or self.stand(before, token):
                    return back, window, token, count + 1
        raise AssertionError("single bytes are tokens")

    def grow(self, state: int, byte: int) -> tuple[int, int]:
        back, window, token, change = self.step(state, byte, self.inner)
        kept = window[-len(back):] if back else ()
        key = back, (*((t, c - change) for t, c in kept), (token, 0))
        found = self.go[state][byte] = self.state(key), change
        return found

    def count(self, word: bytes) -> int:
        if len(self.keys) > self.max_states:
            self.clear()
        go, state, n = self.go, 0, 0
        for byte in word[:-1]:
            found = go[state].get(byte) or self.grow(state, byte)
            state, n = found[0], n + found[1]
        change = self.end[state].get(word[-1])
        if change is None:
            change = self.end[state][word[-1]] = self.step(state, word[-1], self.final)[3]
        return n + change


def byte_characters() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the
    others as the characters from 256 on, in order."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {chr(b): b for b in printable}
    return out | {chr(256 + i): b for i, b in enumerate(
        b for b in range(256) if b not in set(printable))}


class Compiled:
    """The transducers of one tokenizer file, with a bounded word memory."""

    def __init__(self, path: str, max_words: int = 250_000):
        from tokenizers import Regex, Tokenizer, pre_tokenizers
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.encoder = WordEncoder(model["vocab"], model["merges"], model["end_of_word_suffix"])
        self.normalizer = Tokenizer.from_file(path).normalizer
        # added tokens are found in raw texts before anything else
        names = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, names))) if names else None
        self.finders = [(kind, pre_tokenizers.Split(Regex(p), "removed", invert=True))
                        for kind, p in ((SPACE, r"\s+"), (LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"))]
        self.classes = np.full(0x110000, 255, np.uint8)
        self.learn(np.arange(0x250, dtype=np.uint32))
        self.max_words, self.known = max_words, {}

    def learn(self, points: np.ndarray) -> None:
        """Classes of code points, by the tokenizer library's own tables."""
        points = points[(points < 0xD800) | (points > 0xDFFF)]
        text = points.astype("<u4").tobytes().decode("utf-32-le")
        self.classes[points] = OTHER
        for kind, finder in self.finders:
            for _, (a, b) in finder.pre_tokenize_str(text):
                self.classes[points[a:b]] = kind
        for kind, letters in ((APOSTROPHE, "'"), (ENDS, "stmd"), (R, "r"), (V, "v"),
                              (L, "l"), (E, "e")):
            self.classes[[ord(c) for c in letters]] = kind

    def normal(self, text: str) -> str:
        """Below U+0250 composition changes nothing and lower case depends on
        single characters; beyond, the library's normalizer decides."""
        if text.isascii() or max(text) < "ɐ":
            return text.lower()
        return self.normalizer.normalize_str(text)

    def counts(self, texts: list[str | None]) -> np.ndarray:
        out = np.zeros(len(texts), np.int64)
        parts, begins, at = [], [], 0
        for i, text in enumerate(texts):
            begins.append(at)
            pieces = [text or ""]
            if self.special and text and "<|" in text:
                pieces = self.special.split(text)
                out[i] += len(pieces) - 1
            for piece in pieces:
                parts.append(self.normal(piece))
                at += len(parts[-1]) + 1
        joined = " ".join(parts) + " "
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        classes = self.classes[points]
        if (classes == 255).any():
            self.learn(np.unique(points[classes == 255]))
            classes = self.classes[points]
        starts = word_starts(classes)
        edges = np.flatnonzero(starts | (classes == SPACE))
        first = np.flatnonzero(starts[edges])
        begin, end = edges[first], edges[first + 1]
        words = [joined[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
        known = self.known
        if len(known) > self.max_words:
            known.clear()
        for word in set(words).difference(known):
            known[word] = self.encoder.count(word.encode())
        total = np.concatenate([[0], np.cumsum(np.fromiter(
            map(known.__getitem__, words), np.int64, len(words)))])
        at_doc = np.searchsorted(begin, np.array([*begins, len(joined)]))
        return out + np.diff(total[at_doc])


_COMPILED: dict[str, Compiled] = {}


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 2048,
                 text_col: str = "text", block_chars: int = 1 << 20) -> DataFrame:
    """All rows and columns of ``docs`` with ``n_bytes`` (UTF-8 bytes),
    ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens); input
    columns of these names are replaced. ``tokenizer_path`` must be readable
    on every worker (an installed file). Texts are counted whole; a null
    text counts as empty: 0 bytes, 0 tokens. Rows may repeat; an empty table
    gives no rows."""
    out = without(docs, "n_bytes", "n_tokens", "over_limit")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer_path not in _COMPILED:
            _COMPILED[tokenizer_path] = Compiled(tokenizer_path)
        compiled = _COMPILED[tokenizer_path]
        for batch in batches:
            column = batch.column(batch.schema.names.index(text_col))
            texts = column.to_pylist()
            n_bytes = np.array([len(t.encode()) if t else 0 for t in texts], np.int64)
            counts, at = [], 0
            while at < len(texts):
                stop, chars = at, 0
                while stop < len(texts) and (stop == at or chars < block_chars):
                    chars += len(texts[stop] or "")
                    stop += 1
                counts.append(compiled.counts(texts[at:stop]))
                at = stop
            n_tokens = np.concatenate(counts) if counts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(n_bytes), pa.array(n_tokens),
                 pa.array(n_tokens > limit)],
                names=[*batch.schema.names, "n_bytes", "n_tokens", "over_limit"])

    return out.mapInArrow(run, f"{fields}, n_bytes long, n_tokens long, over_limit boolean")

"""Splitting whole texts into the pieces a byte-level BPE works on, for many texts at once.

The rule is that of the public pattern ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``,
written as conditions on neighbouring characters. Which characters are letters, numbers or white space is asked of
the tokenizer itself, once for each character that occurs, so the split is the tokenizer's own whatever Unicode
version it was built with.
"""

from __future__ import annotations

import numpy as np

from kanaat.llm.batches import Texts, per_worker

LETTER, NUMBER, OTHER, SPACE = 0, 1, 2, 3
TOKENIZER_FILE = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER_FILE) -> str:
    """Where the installed vocabulary lies; asked in the task, as each machine has its own copy."""
    import public_tokenizers

    return public_tokenizers.path(name)


def loaded(path: str):
    """The tokenizer of a worker, without truncation and padding."""
    def load():
        from tokenizers import Tokenizer

        made = Tokenizer.from_file(path)
        made.no_truncation()
        made.no_padding()
        return made

    return per_worker(f"tokenizer {path}", load)


def class_of(pieces, char: str) -> int:
    """The class of one character, from how it joins its neighbours."""
    for kind, beside in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")):
        if len(pieces(beside + char + beside)) == 1:
            return kind
    return SPACE


def classes(codes: np.ndarray, path: str) -> np.ndarray:
    """The class of every code point."""
    table = per_worker(f"classes {path}", lambda: np.full(0x110000, -1, np.int8))
    got = table[codes]
    if (got < 0).any():
        pieces = loaded(path).pre_tokenizer.pre_tokenize_str
        for code in np.unique(codes[got < 0]):
            table[code] = OTHER if 0xD800 <= code < 0xE000 else class_of(pieces, chr(int(code)))
        got = table[codes]
    return got


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code point and first byte of every character of valid UTF-8."""
    if not (data >= 0x80).any():
        return data.astype(np.int32), np.arange(len(data))
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    first = data[lead].astype(np.int32)
    codes = first.copy()
    padded = np.concatenate([data, np.zeros(3, np.uint8)])
    for low, high, keep, more in ((0xC0, 0xE0, 0x1F, 1), (0xE0, 0xF0, 0x0F, 2), (0xF0, 0x100, 0x07, 3)):
        here = np.flatnonzero((first >= low) & (first < high))
        code = first[here] & keep
        for k in range(1, more + 1):
            code = (code << 6) | (padded[lead[here] + k].astype(np.int32) & 0x3F)
        codes[here] = code
    return np.minimum(codes, 0x10FFFF), lead


def pieces(texts: Texts, path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end (bytes) and row of every piece; the pieces of a row cover its text."""
    if not len(texts.data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    codes, at = code_points(texts.data)
    n = len(codes)
    kind = classes(codes, path)
    opens_text = np.zeros(n + 1, bool)
    opens_text[np.searchsorted(at, texts.at)] = True
    opens_text[n] = True
    change = np.ones(n, bool)
    change[1:] = (kind[1:] != kind[:-1])
    run = change | opens_text[:n]
    blank = kind == SPACE
    before_blank = np.zeros(n, bool)
    before_blank[1:] = (codes[:-1] == 32) & ~opens_text[1:n]
    # A run begins a piece, or the single blank before it does. The last of several white space characters
    # stands apart from the others when text follows.
    start = run & ~(before_blank & ~blank)
    last_blank = blank.copy()
    last_blank[:-1] &= ~blank[1:]
    last_blank &= ~opens_text[1:]
    start |= last_blank
    # Contractions: an apostrophe that is a run of its own and begins a piece.
    quote = np.flatnonzero((codes == 39) & start & ~opens_text[1:])
    quote = quote[quote + 1 < n]
    if len(quote):
        ends_row = np.concatenate([opens_text, np.ones(2, bool)])
        padded = np.concatenate([codes, np.zeros(3, codes.dtype)])
        a, b = padded[quote + 1], padded[quote + 2]
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = ((a == ord("r")) & (b == ord("e")) | (a == ord("v")) & (b == ord("e")) | (a == ord("l")) & (b == ord("l")))
        two &= ~ends_row[quote + 2]
        for hit, long in ((one, 2), (two & ~one, 3)):
            where = quote[hit]
            for k in range(1, long):
                start[where + k] = False
            inside = where[where + long < n] + long
            start[inside] = True
    first = np.flatnonzero(start)
    begin = at[first]
    row = np.repeat(np.arange(texts.rows), np.diff(np.searchsorted(begin, texts.at)))
    return begin, np.append(begin[1:], len(texts.data)), row

"""Statistics of whole texts, as arrays over the texts of a piece of a batch."""

from __future__ import annotations

import numpy as np

from kanaat.llm.batches import STEP, Texts, mix, per_row, span_hashes, words

WINDOW = 5
# Fixed set of the characters that count as symbols.
SYMBOLS = b"#*$%&|<>"


def byte_sums(texts: Texts, flags: np.ndarray) -> np.ndarray:
    """How many flagged bytes each row has."""
    upto = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return upto[texts.at[1:]] - upto[texts.at[:-1]]


def lines(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every line; a row without line feeds is one line."""
    feeds = np.flatnonzero(texts.data == 10)
    row = np.searchsorted(texts.at, feeds, side="right") - 1
    start = np.concatenate([texts.at[:-1], feeds + 1])
    end = np.concatenate([feeds, texts.at[1:]])
    order = np.argsort(start, kind="stable")
    # The k-th start in order belongs to the k-th end in order: lines do not overlap.
    rows = np.concatenate([np.arange(texts.rows), row])[order]
    return start[order], np.sort(end), rows


def copies(keys: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry how many entries of its row have its key, and whether it is the first of them."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, bool)
    _, first, which, count = np.unique(mix(keys ^ mix((row.astype(np.uint64) + np.uint64(1)) * STEP)), return_index=True,
                                       return_inverse=True, return_counts=True)
    is_first = np.zeros(len(keys), bool)
    is_first[first] = True
    return count[which], is_first


def windows(hashes: np.ndarray, row: np.ndarray, n: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``n`` words of one row, and where it begins."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    begin = np.flatnonzero(row[:len(row) - n + 1] == row[n - 1:])
    total = np.zeros(len(begin), np.uint64)
    for k in range(n):
        total = total * STEP + hashes[begin + k]
    return mix(total), begin


def text_statistics(texts: Texts) -> dict[str, np.ndarray]:
    """Counts of each row: words, code points in words, symbols, repeated lines, words in repeated windows, and
    the further counts that quality models look at."""
    data, rows = texts.data, texts.rows
    start, end, row = words(texts)
    hashes = span_hashes(data, start, end)
    head = (data & 0xC0) != 0x80
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    n_words = per_row(row, rows)
    line_start, line_end, line_row = lines(texts)
    with_word = np.searchsorted(start, line_end) > np.searchsorted(start, line_start)
    line_start, line_end, line_row = line_start[with_word], line_end[with_word], line_row[with_word]
    _, first_line = copies(span_hashes(data, line_start, line_end), line_row)
    keys, begin = windows(hashes, row)
    often, _ = copies(keys, row[begin])
    cover = np.zeros(len(start) + 1, np.int64)
    again = begin[often >= 2]
    np.add.at(cover, again, 1)
    np.add.at(cover, again + WINDOW, -1)
    repeated = np.cumsum(cover[:-1]) > 0
    _, first_word = copies(hashes, row)
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    return {
        "n_words": n_words, "word_chars": byte_sums(texts, head & ~blank), "n_symbols": byte_sums(texts, symbol[data]),
        "n_dup_lines": per_row(line_row[~first_line], rows), "n_repeat_words": per_row(row[repeated], rows),
        "n_lines": per_row(line_row, rows), "n_distinct": per_row(row[first_word], rows),
        "n_upper": byte_sums(texts, (data >= 65) & (data <= 90)), "n_digits": byte_sums(texts, (data >= 48) & (data <= 57)),
        "n_shouts": byte_sums(texts, (data == 33) | (data == 63)), "n_bars": byte_sums(texts, data == 124),
        "n_stops": byte_sums(texts, (data == 46) | (data == 44)), "n_beyond_ascii": byte_sums(texts, head & (data >= 128)),
    }


# What models see: shares, so that long and short texts are alike, and the length itself. With the sign a rising
# value may have for quality: -1 never better, 1 never worse, 0 free.
FEATURES = {
    "symbols": -1, "repeated": -1, "dup_lines": -1, "bars": -1, "shouts": -1, "upper": -1, "distinct": 1, "digits": 0,
    "word_length": 0, "stops": 0, "line_words": 0, "beyond_ascii": 0, "log_words": 0,
}


def features(stats: dict[str, np.ndarray]) -> np.ndarray:
    """One row of FEATURES per text; a text without words has zeros."""
    words_ = np.maximum(stats["n_words"], 1)
    chars, lines_ = np.maximum(stats["word_chars"], 1), np.maximum(stats["n_lines"], 1)
    columns = {
        "symbols": stats["n_symbols"] / chars, "repeated": stats["n_repeat_words"] / words_,
        "dup_lines": stats["n_dup_lines"] / lines_, "bars": stats["n_bars"] / chars, "shouts": stats["n_shouts"] / chars,
        "upper": stats["n_upper"] / chars, "distinct": stats["n_distinct"] / words_, "digits": stats["n_digits"] / chars,
        "word_length": stats["word_chars"] / words_, "stops": stats["n_stops"] / chars,
        "line_words": stats["n_words"] / lines_, "beyond_ascii": stats["n_beyond_ascii"] / chars,
        "log_words": np.log1p(stats["n_words"]),
    }
    return np.stack([columns[name] for name in FEATURES], axis=1).astype(np.float64)

"""Byte-pair encoding and decoding of whole texts by walking a trie of the distinct words.

What a byte pair encoder needs to know of a prefix is one token: the last of the prefix's own encoding. The encoding
of a word is that token, then the last token of what stands before it, and so on. So the words of a batch are put in
a trie (kept as sorted words: the path of a word shares the first bytes of the path before it) and walked depth
first; each node gets its last token from the states above it, once, however many words share it. A token may end a
prefix if it may follow the state where it begins: if merging by rank, the two side by side stay apart.

Texts are cut into words by the tokenizer's own rule (`pretokens`), added tokens stand for themselves. Decoding puts
the bytes of the tokens together. Null texts count as empty and have no ids. Ids may be null or repeated; other
columns are left out. A worker keeps at most ``token_ids.MOST_KEPT`` words.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from kanaat.llm.batches import Texts, chunks, gather_lists, per_worker
from kanaat.llm.pretokens import loaded, tokenizer_path
from kanaat.llm.registry import query, table
from kanaat.llm.token_ids import encoded

Batches = Iterator[pa.RecordBatch]


def byte_letters() -> dict[str, int]:
    """The letter that a byte-level vocabulary writes for each byte: printable ones stand for themselves, the rest
    for 256, 257 and so on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens as bytes, the two halves each was merged from, and which two tokens may stand side by side."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        letters = byte_letters()
        self.bytes_of = {i: bytes(letters[c] for c in word) for word, i in model["vocab"].items() if all(c in letters for c in word)}
        self.id_of = {b: i for i, b in self.bytes_of.items()}
        self.merged: dict[tuple[int, int], int] = {}
        self.rank: dict[int, int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = (model["vocab"][x] for x in (pair if isinstance(pair, list) else pair.split(" ")))
            whole = self.id_of[self.bytes_of[left] + self.bytes_of[right]]
            self.merged.setdefault((left, right), rank)
            if whole not in self.halves:
                self.halves[whole], self.rank[whole] = (left, right), rank
        self.longest = [1] * 256
        for b in self.id_of:
            self.longest[b[-1]] = max(self.longest[b[-1]], len(b))
        self.apart: dict[tuple[int, int], bool] = {}
        self.whole: dict[int, bool] = {}

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether the encoding of the two tokens' bytes is these two tokens. Merges are undone from the latest to
        the earliest; at no time may the tokens that then touch have an earlier merge with each other than the one
        undone last."""
        before, merged, rank = 1 << 60, self.merged, self.rank
        while True:
            join = merged.get((left, right))
            if join is not None and join < before:
                return False
            a, b = rank.get(left, -1), rank.get(right, -1)
            if a < 0 and b < 0:
                return True
            # Of merges of equal rank the leftmost comes first: a join wins over one to its right, not to its left.
            if a > b:
                before, left = a, self.halves[left][1]
            else:
                before, right = b + 1, self.halves[right][0]

    def may_follow(self, left: int, right: int) -> bool:
        known = self.apart.get((left, right))
        if known is None:
            if len(self.apart) > 2_000_000:
                self.apart.clear()
            known = self.apart[left, right] = self.stay_apart(left, right)
        return known

    def is_whole(self, token: int) -> bool:
        """Whether the token's bytes are encoded as the token itself."""
        known = self.whole.get(token)
        if known is None:
            halves = self.halves.get(token)
            known = self.whole[token] = halves is None or self.by_rank(self.bytes_of[token]) == [token]
        return known

    def by_rank(self, word: bytes) -> list[int]:
        """The plain way: merge the pair of least rank, leftmost first, until none is left."""
        ids = [self.id_of[bytes([b])] for b in word]
        while True:
            best = min(((self.merged[p], i) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in self.merged), default=None)
            if best is None:
                return ids
            i = best[1]
            ids[i:i + 2] = [self.id_of[self.bytes_of[ids[i]] + self.bytes_of[ids[i + 1]]]]

    def walk(self, words: list[bytes]) -> list[list[int]]:
        """The ids of every word, by a depth-first walk of the trie of all of them."""
        out: list[list[int]] = [[]] * len(words)
        token, size, id_of, longest, apart = [0], [0], self.id_of, self.longest, self.apart
        path = b""
        for place in sorted(range(len(words)), key=words.__getitem__):
            word = words[place]
            shared, most = 0, min(len(path), len(word))
            if path[:most] == word[:most]:
                shared = most
            else:
                while path[shared] == word[shared]:
                    shared += 1
            del token[shared + 1:], size[shared + 1:]
            for depth in range(shared + 1, len(word) + 1):
                for n in range(min(longest[word[depth - 1]], depth), 0, -1):
                    last = id_of.get(word[depth - n:depth])
                    if last is None:
                        continue
                    if n == depth:
                        if self.is_whole(last):
                            break
                        continue
                    known = apart.get((token[depth - n], last))
                    if self.may_follow(token[depth - n], last) if known is None else known:
                        break
                token.append(last)
                size.append(n)
            path, depth, ids = word, len(word), []
            while depth:
                ids.append(token[depth])
                depth -= size[depth]
            out[place] = ids[::-1]
        return out


def vocabulary(path: str) -> Vocabulary:
    return per_worker(f"vocabulary {path}", lambda: Vocabulary(path))


def token_bytes(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all tokens one after another, and where each id's begin and how many they are."""
    def make():
        of = dict(vocabulary(path).bytes_of)
        of |= {i: t.content.encode() for i, t in loaded(path).get_added_tokens_decoder().items()}
        count = np.zeros(max(of) + 1, np.int64)
        count[list(of)] = [len(b) for b in of.values()]
        flat = np.frombuffer(b"".join(of.get(i, b"") for i in range(len(count))), np.uint8)
        return flat, np.cumsum(count) - count, count

    return per_worker(f"token bytes {path}", make)


def encode_texts(texts: Texts, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rows one after another, and how many each row has."""
    def walk(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ids = vocabulary(path).walk(words)
        return np.fromiter((i for word in ids for i in word), np.uint32), np.fromiter(map(len, ids), np.int64, len(ids))

    return encoded(texts, path, walk, "trie")


def decode_ids(ids: np.ndarray, counts: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows one after another, and where each row's begin (rows + 1)."""
    flat, start, count = token_bytes(path)
    ids = ids.astype(np.int64)
    lengths = count[ids]
    upto = np.concatenate([[0], np.cumsum(lengths)])
    return gather_lists(flat, start[ids], lengths), upto[np.concatenate([[0], np.cumsum(counts)])]


def encode_batches(tokenizer: str | None = None) -> Callable[[Batches], Batches]:
    """Batches of (id, text) to batches of (id, ids)."""
    def run(batches: Batches) -> Batches:
        path = tokenizer or tokenizer_path()
        for batch in batches:
            for texts in chunks(batch.column(1)):
                ids, counts = encode_texts(texts, path)
                at = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(at), pa.array(ids.view(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(texts.first, texts.rows), lists], ["doc_id", "ids"])

    return run


def decode_batches(tokenizer: str | None = None) -> Callable[[Batches], Batches]:
    """Batches of (id, ids) to batches of (id, ids, text)."""
    def run(batches: Batches) -> Batches:
        path = tokenizer or tokenizer_path()
        for batch in batches:
            lists = batch.column(1)
            counts = np.diff(lists.offsets.to_numpy())
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            data, at = decode_ids(ids, counts, path)
            raw = data.tobytes()
            texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    return run


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """``doc_id`` and ``ids`` (array<int>) of every row."""
    of = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(encode_batches(tokenizer), f"doc_id {of}, ids array<int>")


def decode(rows: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``doc_id``, ``ids`` and the ``text`` they stand for."""
    of = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "ids").mapInArrow(decode_batches(tokenizer), f"doc_id {of}, ids array<int>, text string")


def digests(batches: Batches) -> Batches:
    """Batches of (doc_id, ids, text) to counts and digests."""
    for batch in batches:
        lists = batch.column(1)
        at = lists.offsets.to_numpy()
        raw = lists.values.to_numpy(zero_copy_only=False).astype("<u4").tobytes()
        yield pa.RecordBatch.from_arrays([
            batch.column(0), pa.array(np.diff(at).astype(np.int64)),
            pa.array([hashlib.sha256(raw[4 * a:4 * b]).hexdigest() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], pa.string()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in batch.column(2).to_pylist()], pa.string()),
        ], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


@query("op8_trie_bpe")
def op8_trie_bpe(spark: SparkSession, folder: str) -> DataFrame:
    def run(batches: Batches) -> Batches:  # in one task: ids need not travel between the steps
        return digests(decode_batches()(encode_batches()(batches)))

    return table(spark, folder, "documents").select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")

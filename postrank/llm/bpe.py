"""Byte-pair encoding and decoding by batched merge rounds.

The symbols of many pieces (words, to most tokenizers) lie in one flat array. The
rank of each pair of neighbours is found by binary search over the sorted keys of
all merges, ``left << 32 | right``. A round takes the lowest rank of each piece, merges
all pairs of that rank, leftmost first where they overlap, and looks up again only the
pairs next to a merge. Pieces without a mergeable pair leave the array. That equals
merging one pair at a time as long as no merge makes a symbol that an earlier merge
uses; tables where one does are merged one pair a round.

Reads the JSON files of the ``tokenizers`` library for byte-level BPE. Two routes
lead from texts to pieces:

* If the file's normaliser and pre-tokenizer are known to treat each run between
  white space alone (``SPLIT_PATTERN``), every different run of a batch is cut once,
  and what it becomes is remembered.
* Any other file: the library's own normaliser and pre-tokenizer cut the whole text.

Null and empty texts have no ids. Strings of the file's added tokens in a text become
those tokens, as in the library. No id can be lost or cut: there is no truncation
or padding. Texts of any length are processed whole; a piece of n symbols takes memory
for n of them and as many rounds as it has different ranks to merge.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: No rank: the pair does not merge.
NONE = np.int32(0x7FFFFFFF)
#: Bytes of text whose words are looked up together.
BLOCK_BYTES = 8 << 20
#: Pieces merged at once.
MERGE_PIECES = 1 << 16
#: Runs and pieces a Python process remembers, each; a full memory starts again.
REMEMBERED = 600_000

# --- Fixed value: the split of the word-end tokenizers, which drop white space ---
SPLIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# --- Fixed value: normalisers that treat a run between ASCII white space by itself ---
LOCAL_NORMALIZERS = ("NFC", "Replace", "Lowercase")
#: Up to here characters are NFC already, and their classes and lower case are settled.
PLAIN_END = 0x17F


def byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary.

    Printable characters of Latin-1 stand for themselves, the others for characters
    from U+0100 on.
    """
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(hidden)) for b in range(256)]


def _plain_pattern() -> re.Pattern:
    """SPLIT_PATTERN for characters up to PLAIN_END; a line feed is a piece of its own."""
    chars = [chr(c) for c in range(PLAIN_END + 1)]
    letters = re.escape("".join(c for c in chars if unicodedata.category(c)[0] == "L"))
    numbers = re.escape("".join(c for c in chars if unicodedata.category(c)[0] == "N"))
    space = r"\x09-\x0D\x20\x85\xA0"
    return re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|\n|[^{space}{letters}{numbers}]+")


def taken(flat: np.ndarray, start: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries ``numbers`` of a store one after another, and where each begins (and all end)."""
    sizes = start[numbers + 1] - start[numbers]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    return flat[np.repeat(start[numbers] - ends[:-1], sizes) + np.arange(ends[-1])], ends


class Store:
    """Ids by key, for keys added in batches."""

    def __init__(self) -> None:
        self.number: dict = {}
        self.flat, self.start = np.empty(0, np.uint32), np.zeros(1, np.int64)

    def add(self, keys: list, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.number.update(zip(keys, range(len(self.number), len(self.number) + len(keys))))
        self.flat = np.concatenate([self.flat, ids])
        self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(sizes)])

    def numbers(self, keys: list) -> np.ndarray:
        return np.fromiter(map(self.number.__getitem__, keys), np.int64, len(keys))


class Merges:
    """The merge table of a vocabulary."""

    def __init__(self, vocab: dict[str, int], merges: list, word_end: str = "") -> None:
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in merges]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys = left << 32 | right
        order = np.argsort(keys, kind="stable")
        order = order[np.concatenate([[True], np.diff(keys[order]) > 0])] if len(order) else order
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int32), made
        # Whether every merge comes after those that make what it joins.
        last = np.full(max(vocab.values()) + 2, -1, np.int64)
        np.maximum.at(last, made, np.arange(len(made)))
        self.in_order = bool((np.maximum(last[left], last[right]) < np.arange(len(made))).all())
        chars = byte_characters()
        self.inside = np.array([vocab.get(c, -1) for c in chars], np.int64)
        self.at_end = np.array([vocab.get(c + word_end, -1) for c in chars], np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(left), NONE)
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def symbols(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all pieces and the piece of each; bytes without a symbol are left out."""
        coded = [p.encode("utf-8", "surrogatepass") for p in pieces]
        data = np.frombuffer(b"".join(coded), np.uint8)
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        symbols, piece = self.inside[data], np.repeat(np.arange(len(pieces)), sizes)
        ends = np.cumsum(sizes)[sizes > 0] - 1
        symbols[ends] = self.at_end[data[ends]]
        known = symbols >= 0
        return symbols[known], piece[known]

    def merge(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces one after another, how many each has)."""
        symbols, piece = self.symbols(pieces)
        sizes = np.zeros(len(pieces), np.int64)
        done_ids, done_piece = [], []
        rank = np.full(len(symbols), NONE)
        inner = np.flatnonzero(piece[1:] == piece[:-1]) if len(piece) else np.empty(0, np.int64)
        rank[inner] = self.rank(symbols[inner], symbols[inner + 1])
        while len(symbols):
            first = np.flatnonzero(np.concatenate([[True], piece[1:] != piece[:-1]]))
            best = np.minimum.reduceat(rank, first)
            best = np.repeat(best, np.diff(np.concatenate([first, [len(piece)]])))
            open_ = best != NONE
            if not open_.all():
                done_ids.append(symbols[~open_])
                done_piece.append(piece[~open_])
                symbols, piece, rank, best = symbols[open_], piece[open_], rank[open_], best[open_]
                if not len(symbols):
                    break
            at = np.flatnonzero(rank == best)
            # In a run of overlapping pairs (aaa) every other one merges; a piece's last
            # symbol has no rank, so runs never cross pieces.
            begins = np.concatenate([[True], np.diff(at) != 1])
            if self.in_order:
                place = np.arange(len(at)) - np.maximum.accumulate(np.where(begins, np.arange(len(at)), 0))
                at = at[place % 2 == 0]
            else:
                at = at[np.concatenate([[True], piece[at][1:] != piece[at][:-1]])]
            symbols[at] = self.made[rank[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            # The merged symbol takes the place of the right one as far as "last of its piece" goes.
            at = np.cumsum(keep)[at] - 1
            symbols, piece, rank = symbols[keep], piece[keep], rank[keep]
            changed = np.unique(np.concatenate([at, at[at > 0] - 1]))
            rank[changed] = NONE
            changed = changed[changed + 1 < len(piece)]
            changed = changed[piece[changed] == piece[changed + 1]]
            rank[changed] = self.rank(symbols[changed], symbols[changed + 1])
        if not done_ids:
            return np.empty(0, np.uint32), sizes
        ids, of = np.concatenate(done_ids), np.concatenate(done_piece)
        order = np.argsort(of, kind="stable")
        return ids[order].astype(np.uint32), np.bincount(of, minlength=len(pieces))


class Bpe:
    """Encodes and decodes by a JSON file of the ``tokenizers`` library."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges") if model.get(k)]
        if model["type"] != "BPE" or odd or "ByteLevel" not in json.dumps(spec["pre_tokenizer"]):
            raise ValueError(f"no plain byte-level BPE: {path} {odd}")
        added = spec["added_tokens"]
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError(f"added tokens that depend on what is beside them: {path}")
        self.vocab = {**model["vocab"], **{t["content"]: t["id"] for t in added}}
        self.merges = Merges(model["vocab"], model["merges"], model.get("end_of_word_suffix") or "")
        self.added = {t["content"]: t["id"] for t in added if t["content"]}
        names = sorted(self.added, key=len, reverse=True)
        self.added_pattern = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        library = Tokenizer.from_file(path)
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer
        self.by_run = self._splits_runs(spec) and not any(re.search(r"\s", n) for n in names)
        self.plain = _plain_pattern()
        self.byte_of = {c: b for b, c in enumerate(byte_characters())}
        self._forget()
        decoder = spec["decoder"]
        if decoder and decoder["type"] != "ByteLevel":
            raise ValueError(f"no decoder for {decoder['type']}")
        self.bytes_decoded = bool(decoder)
        self.tokens = self._token_table()

    @staticmethod
    def _splits_runs(spec: dict) -> bool:
        normalizer = spec["normalizer"] or {"type": "Sequence", "normalizers": []}
        steps = normalizer.get("normalizers", [normalizer])
        shape = [s["type"] for s in steps] == list(LOCAL_NORMALIZERS)
        spaces = shape and steps[1]["pattern"] == {"Regex": "\\s+"} and steps[1]["content"] == " "
        cut = (spec["pre_tokenizer"].get("pretokenizers") or [{}])[0]
        return bool(
            spaces and cut.get("type") == "Split" and cut["pattern"] == {"Regex": SPLIT_PATTERN}
            and cut["behavior"] == "Removed" and cut["invert"]
            and not any(t.get("add_prefix_space") or t.get("use_regex") for t in spec["pre_tokenizer"]["pretokenizers"][1:])
        )

    def _token_table(self) -> pa.LargeBinaryArray:
        """What each id decodes to, and null for numbers that are no id."""
        held: list[bytes | None] = [None] * (max(self.vocab.values()) + 1)
        for token, i in self.vocab.items():
            if self.bytes_decoded and all(c in self.byte_of for c in token):
                held[i] = bytes(self.byte_of[c] for c in token)
            else:
                held[i] = token.encode() + (b"" if self.bytes_decoded else b" ")
        return pa.array(held, pa.large_binary())

    def _forget(self) -> None:
        self.runs, self.pieces = Store(), Store()
        for i in self.added.values():
            self.pieces.add([i], np.array([i], np.uint32), np.array([1]))

    # ---- encoding ----

    def cut(self, text: str) -> list[str | int]:
        """Pieces of a text, or the ids of added tokens, by the library's own parts."""
        out: list[str | int] = []
        for i, part in enumerate(self.added_pattern.split(text) if self.added_pattern else [text]):
            if i % 2:
                out.append(self.added[part])
            elif part:
                normal = self.normalizer.normalize_str(part) if self.normalizer else part
                out += [
                    bytes(map(self.byte_of.__getitem__, p)).decode("utf-8", "surrogatepass")
                    for p, _ in self.pre_tokenizer.pre_tokenize_str(normal)
                ]
        return out

    def _numbers_of_pieces(self, pieces: list[str | int]) -> np.ndarray:
        known = self.pieces.number
        new = list(dict.fromkeys(p for p in pieces if p not in known))
        for at in range(0, len(new), MERGE_PIECES):
            # of like length, so that few long ones do not keep many short ones waiting
            part = sorted(new[at : at + MERGE_PIECES], key=len)
            self.pieces.add(part, *self.merges.merge(part))
        return self.pieces.numbers(pieces)

    def _learn_runs(self, runs: list[str]) -> None:
        hard = [r for r in runs if ord(max(r, default="a")) > PLAIN_END or (self.added_pattern and self.added_pattern.search(r))]
        easy = list(set(runs).difference(hard)) if hard else runs
        # Lower case of plain characters is that of each alone; a line feed ends each run.
        found: list[str | int] = self.plain.findall("".join(f"{r}\n" for r in easy).lower())
        for run in hard:
            found += [*self.cut(run), "\n"]
        marks = np.fromiter((p == "\n" for p in found), bool, len(found))
        numbers = self._numbers_of_pieces(["" if p == "\n" else p for p in found])
        ids, ends = taken(self.pieces.flat, self.pieces.start, numbers)
        last = np.flatnonzero(marks)
        sizes = np.diff(np.concatenate([[0], ends[last + 1]]))
        self.runs.add([*easy, *hard], ids, sizes)

    def _encode_runs(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        if len(self.runs.number) + len(words) > REMEMBERED or len(self.pieces.number) > REMEMBERED:
            self._forget()
        known = self.runs.number
        new = [w for w in words if w not in known]
        if new:
            self._learn_runs(new)
        flat, start = taken(self.runs.flat, self.runs.start, self.runs.numbers(words))
        held = _binary(flat, start).take(coded.indices.cast("int64"))
        ends = np.frombuffer(held.buffers()[1], np.int64, len(held) + 1, held.offset * 8)
        offsets = split.offsets.to_numpy()
        return _data(held).view("<u4"), ends[offsets - offsets[0]] // 4

    def _encode_whole(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        cut = [self.cut(t) for t in texts.to_pylist()]
        if len(self.pieces.number) > REMEMBERED:
            self._forget()
        numbers = self._numbers_of_pieces([p for c in cut for p in c])
        ids, ends = taken(self.pieces.flat, self.pieces.start, numbers)
        return ids, ends[np.concatenate([[0], np.cumsum([len(c) for c in cut], dtype=np.int64)])]

    def encode(self, texts: pa.Array) -> pa.LargeBinaryArray:
        """The ids of each text as little-endian unsigned 32-bit integers; a null text has none."""
        texts = texts.cast(pa.large_string()).fill_null("")
        parts = [(self._encode_runs if self.by_run else self._encode_whole)(b) for b in text_blocks(texts)]
        return pa.concat_arrays([_binary(ids, ends) for ids, ends in parts]) if parts else pa.array([], pa.large_binary())

    # ---- decoding ----

    def decode(self, ids: pa.Array) -> pa.LargeStringArray:
        """The text of each row of ids; numbers that are no id are skipped, special tokens are not."""
        ids = ids.cast(pa.large_binary()).fill_null(b"")
        ends = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1, ids.offset * 8) // 4
        flat = _data(ids).view("<u4")
        known = flat < len(self.tokens)
        if not known.all():
            flat, ends = flat[known], np.concatenate([[0], np.cumsum(known)])[ends - ends[0]]
        ends = ends - ends[0]
        tokens = self.tokens.take(pa.array(flat.astype(np.int64)))
        at = np.frombuffer(tokens.buffers()[1], np.int64, len(tokens) + 1)[ends] if len(tokens) else np.zeros(len(ids) + 1, np.int64)
        data = _data(tokens)
        if self.bytes_decoded:
            return pa.array([bytes(data[i:j]).decode("utf-8", "replace") for i, j in zip(at, at[1:])], pa.large_string())
        # The space behind the last token of each row goes.
        some = at[1:] > at[:-1]
        data = np.delete(data, at[1:][some] - 1)
        at = at - np.concatenate([[0], np.cumsum(some)])
        return pa.LargeStringArray.from_buffers(len(ids), pa.py_buffer(at), pa.py_buffer(data))


def _binary(ids: np.ndarray, ends: np.ndarray) -> pa.LargeBinaryArray:
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends * 4), pa.py_buffer(np.ascontiguousarray(ids, "<u4"))]
    )


def _data(array: pa.Array) -> np.ndarray:
    """The bytes of a large binary array, without what lies before and behind."""
    if not len(array) or array.buffers()[2] is None:
        return np.empty(0, np.uint8)
    ends = np.frombuffer(array.buffers()[1], np.int64, len(array) + 1, array.offset * 8)
    return np.frombuffer(array.buffers()[2], np.uint8)[ends[0] : ends[-1]]


def text_blocks(texts: pa.Array, size: int | None = None) -> Iterator[pa.Array]:
    """Runs of rows with about ``size`` bytes of text each (BLOCK_BYTES); a longer text is alone."""
    size = size or BLOCK_BYTES
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + size, side="right")))
        yield texts.slice(start, stop - start)
        start = stop


_open: dict[str, Bpe] = {}


def bpe_of(path: str) -> Bpe:
    """The tokenizer of this Python process, which serves one task after another."""
    if path not in _open:
        _open[path] = Bpe(path)
    return _open[path]


def encode_column(text: Column, tokenizer: str) -> Column:
    """Token ids of a text column, as little-endian unsigned 32-bit integers in one binary.

    ``tokenizer`` is the place of the JSON file on every executor. A null text has the
    ids of an empty one: none.
    """

    def encode(texts: pa.Array) -> pa.Array:
        return bpe_of(tokenizer).encode(texts).cast(pa.binary())

    return F.arrow_udf(encode, "binary")(text)


def decode_column(ids: Column, tokenizer: str) -> Column:
    """The text of a column of ids as ``encode_column`` gives them, as the library's
    ``decode(ids, skip_special_tokens=False)``. Null ids give an empty text."""

    def decode(batch: pa.Array) -> pa.Array:
        return bpe_of(tokenizer).decode(batch).cast(pa.string())

    return F.arrow_udf(decode, "string")(ids)

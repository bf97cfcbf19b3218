"""Byte-pair encoding by dynamic programming over prefixes, and decoding.

For every prefix of a piece there is one last token that byte-pair encoding can end it with. It is found
from the tokens that end there (given longest first by an automaton with suffix links over the
vocabulary): the first token whose predecessor, the last token of the prefix before it, may stand
beside it. Following the stored tokens back from the end gives the exact ids, in time linear in the piece
but for the tokens tried. Two tokens may stand side by side if no merge rule would have joined a right edge
of the first to a left edge of the second before either edge was merged into something larger.

The vocabulary file of a public tokenizer is a parameter (`tokenizers` JSON: BPE with byte-level characters and
an end-of-word suffix, or none). Only its tables are read; text is split, merged and decoded here.

Defined results: a null or empty text has no ids and decodes to the empty string; a null list of ids decodes
to the empty string; the strings of special tokens in a text become those tokens; repeated rows are
encoded alike; other columns are passed over. A worker keeps the ids of at most `CACHE_PIECES` recent pieces.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradewise.llm import tokens

CACHE_PIECES = 1_000_000
# Only memory and speed depend on it: a chunk's arrays take about a hundred bytes for each byte of text at their peak.
CHUNK_BYTES = 1 << 19
# Fixed value: the split pattern that `Pieces` finds by array operations; any other goes through `regex`.
COMMON_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
VOCABULARY = "word_bpe_49k.json"
SALT, CHECK_SALT = tokens.mixed_int(7), tokens.mixed_int(8)
LAST = 0x100  # added to the last byte's symbol where the vocabulary marks word ends


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if printable, else the next from U+0100."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Encoder:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.specials = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        self.size = max([*self.vocab.values(), *self.specials.values()]) + 1
        names = [""] * self.size
        for text, i in [*self.vocab.items(), *self.specials.items()]:
            names[i] = text
        self.names = pa.array(names, pa.string())
        self.special_pattern = (
            regex.compile("|".join(regex.escape(s) for s in sorted(self.specials, key=len, reverse=True)))
            if self.specials else None
        )
        self.steps = _flat(spec.get("normalizer"), "normalizers")
        split = [p for p in _flat(spec.get("pre_tokenizer"), "pretokenizers") if p["type"] == "Split"]
        self.pieces = regex.compile(_pattern(split[0]["pattern"]))

        # Pairs of tokens are numbers, first * size + second: workers hold many of them.
        self.join: dict[int, int] = {}
        # The tokens that a token is merged from, -1 if none.
        self.left, self.right = [-1] * self.size, [-1] * self.size
        order = []
        for rule in model["merges"]:
            a, b = rule if isinstance(rule, list) else rule.split(" ")
            merged, first, second = self.vocab[a + b], self.vocab[a], self.vocab[b]
            self.join[first * self.size + second] = merged
            self.left[merged], self.right[merged] = first, second
            order.append(merged)
        if order != sorted(set(order)):
            raise ValueError("the ids of merged tokens must follow the order of the merge rules")
        characters = byte_characters()
        code = {c: b for b, c in enumerate(characters)}
        self.automaton = ahocorasick.Automaton()
        for text, i in self.vocab.items():
            ends = bool(self.suffix) and text.endswith(self.suffix) and len(text) > len(self.suffix)
            stem = text[: len(text) - len(self.suffix)] if ends else text
            symbols = [code[c] for c in stem]
            if ends:
                symbols[-1] += LAST
            self.automaton.add_word("".join(map(chr, symbols)), (i, len(symbols)))
        self.automaton.make_automaton()
        self.beside: dict[int, bool] = {}
        self.known = Known()

    def may_stand(self, first: int, second: int) -> bool:
        pair = first * self.size + second
        known = self.beside.get(pair)
        if known is None:
            known = True
            # after: the token that an edge is merged into next; the whole token's is endless.
            a, after_a = first, self.size
            while known and a >= 0:
                b, after_b = second, self.size
                while b >= 0:
                    merged = self.join.get(a * self.size + b)
                    # Of equal rules the leftmost goes first, so a tie is lost on the left and won on the right.
                    if merged is not None and merged < after_a and merged <= after_b:
                        known = False
                        break
                    b, after_b = self.left[b], b
                a, after_a = self.right[a], a
            if len(self.beside) > CACHE_PIECES // 2:
                self.beside.clear()
            self.beside[pair] = known
        return known

    def encode_piece(self, piece: str) -> list[int]:
        raw = piece.encode("utf-8", "surrogatepass")
        symbols = raw.decode("latin-1")
        if self.suffix:
            symbols = symbols[:-1] + chr(raw[-1] + LAST)
        n = len(symbols)
        last = [-1] * (n + 1)
        size = [0] * (n + 1)
        may_stand = self.may_stand
        for end, (token, length) in self.automaton.iter(symbols):
            end += 1
            if last[end] >= 0:
                continue
            before = end - length
            if before == 0 or (last[before] >= 0 and may_stand(last[before], token)):
                last[end], size[end] = token, length
        if last[n] < 0:
            raise ValueError("the vocabulary lacks a byte of the text")
        ids = []
        while n:
            ids.append(last[n])
            n -= size[n]
        return ids[::-1]

    def normal(self, text: str) -> str:
        for step in self.steps:
            if step["type"] == "NFC":
                text = text if text.isascii() else unicodedata.normalize("NFC", text)
            elif step["type"] == "Lowercase":
                # Character by character: a final sigma is no special case.
                text = text.replace("Σ", "σ").lower()
            elif step["type"] == "Replace":
                # White space only parts pieces here, however long it is.
                if regex.search(r"\S", step["content"]) or _pattern(step["pattern"]) != r"\s+":
                    text = regex.sub(_pattern(step["pattern"]), step["content"], text)
            else:
                raise ValueError(f"unknown normalizer {step['type']}")
        return text

    def encode(self, text: str | None) -> np.ndarray:
        """The ids of one text."""
        ids: list[int] = []
        at = 0
        for m in self.special_pattern.finditer(text or "") if self.special_pattern else ():
            for piece in self.pieces.findall(self.normal(text[at: m.start()])):
                ids += self.encode_piece(piece)
            ids.append(self.specials[m.group()])
            at = m.end()
        for piece in self.pieces.findall(self.normal((text or "")[at:])):
            ids += self.encode_piece(piece)
        return np.array(ids, "<u4")

    def encode_all(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one behind the other, and where each text's begin."""
        odd = {
            i: self.encode(t) for i, t in enumerate(texts)
            if t and self.special_pattern and self.special_pattern.search(t)
        }
        if self.pieces.pattern != COMMON_SPLIT:
            odd = {i: self.encode(t) for i, t in enumerate(texts)}
        normal = [self.normal(t) if t and i not in odd else "" for i, t in enumerate(texts)]
        joined = "\n".join(normal)
        start, end, keys, checks = split(joined)
        ids, sizes = self.known.ids_of(keys, checks, lambda k: self.encode_piece(joined[start[k]: end[k]]))
        bounds = np.concatenate(([0], np.cumsum([len(t) + 1 for t in normal])))
        before = np.concatenate(([0], np.cumsum(sizes)))[np.searchsorted(start, bounds)]
        if odd:
            parts = [odd.get(i, ids[before[i]: before[i + 1]]) for i in range(len(texts))]
            ids = np.concatenate(parts)
            before = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
        return ids, before

    def decode(self, ids: pa.Array) -> pa.Array:
        """Texts of an array of lists of ids: the tokens, joined by spaces (the file names no decoder)."""
        if ids.null_count:
            ids = pc.fill_null(ids, pa.scalar([], ids.type))
        first, end = ids.offsets[0].as_py(), ids.offsets[-1].as_py()
        named = self.names.take(ids.values.slice(first, end - first))
        offsets = pc.subtract(ids.offsets, ids.offsets[0])
        return pc.binary_join(pa.ListArray.from_arrays(offsets, named), " ")


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """Of each code point: 0 white space, 1 letter, 2 number, 3 anything else."""
    every = np.delete(np.arange(0x110000, dtype="<u4"), slice(0xD800, 0xE000)).tobytes().decode("utf-32-le")
    kinds = np.full(0x110000, 3, np.uint8)
    for kind, pattern in ((1, r"\p{L}+"), (2, r"\p{N}+"), (0, r"\s+")):
        for m in regex.finditer(pattern, every):
            a, b = ord(every[m.start()]), ord(every[m.end() - 1])
            kinds[a: b + 1] = kind
    kinds[0xD800:0xE000] = 3
    return kinds


def split(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and two hashes of the pieces of `COMMON_SPLIT` in a text without capitals."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(points)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    padded = np.concatenate((points, np.zeros(4, np.uint32)))
    kind = np.concatenate((_kinds()[points], np.zeros(4, np.uint8)))
    start = np.zeros(n + 4, bool)
    start[1:n] = (kind[1:n] != kind[: n - 1]) | (kind[1:n] == 2)
    start[0] = True
    edge = start.copy()
    start[:n] &= kind[:n] != 0
    # An apostrophe that opens a run takes s, t, m, d, re, ve or ll behind it.
    at = np.flatnonzero(start[:n] & (points == ord("'")) & (kind[1: n + 1] == 1))
    one, two = padded[at + 1], padded[at + 2]
    letters = {c: ord(c) for c in "stmdrevl"}
    short = np.isin(one, [letters[c] for c in "stmd"])
    long = (two == letters["e"]) & ((one == letters["r"]) | (one == letters["v"]))
    long |= (two == letters["l"]) & (one == letters["l"])
    took = np.where(short, 1, np.where(long, 2, 0))
    at, took = at[took > 0], took[took > 0]
    start[at + 1] = edge[at + 1] = False
    rest = at + 1 + took
    rest = rest[kind[rest] == 1]
    start[rest] = edge[rest] = True
    edges = np.append(np.flatnonzero(edge[:n]), n)
    first = np.flatnonzero(start[:n])
    last = edges[np.searchsorted(edges, first, "right")]
    keys, checks = (
        tokens.slice_hashes(lambda a, b, salt=salt: tokens.mix(points[a:b].astype(np.uint64) ^ salt), first, last) for salt in (SALT, CHECK_SALT)
    )
    return first, last, keys, checks


class Known:
    """Ids of the pieces seen, by hash; emptied when it holds `CACHE_PIECES` of them.

    A second hash of each piece tells whether two pieces met in the first; then all are encoded one by one.
    """

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.checks = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.uint32)

    def ids_of(self, keys: np.ndarray, checks: np.ndarray, compute) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces in their order, and how many each has; `compute(k)` gives those of piece k."""
        unique, first, which = np.unique(keys, return_index=True, return_inverse=True)
        slot = np.searchsorted(self.keys, unique)
        if len(self.keys):
            missing = np.flatnonzero(self.keys[np.minimum(slot, len(self.keys) - 1)] != unique)
        else:
            missing = np.arange(len(unique))
        if len(missing):
            if len(self.keys) + len(missing) > CACHE_PIECES and len(self.keys):
                self.clear()
                return self.ids_of(keys, checks, compute)
            fresh = [compute(k) for k in first[missing].tolist()]
            sizes = np.array([len(x) for x in fresh], np.int32)
            at = len(self.ids) + np.concatenate(([0], np.cumsum(sizes)[:-1]))
            self.ids = np.concatenate((self.ids, np.array([i for x in fresh for i in x], np.uint32)))
            self.at = np.insert(self.at, slot[missing], at)
            self.size = np.insert(self.size, slot[missing], sizes)
            self.checks = np.insert(self.checks, slot[missing], checks[first[missing]])
            self.keys = np.insert(self.keys, slot[missing], unique[missing])
            slot = np.searchsorted(self.keys, unique)
        if (self.checks[slot][which] != checks).any():
            each = [compute(k) for k in range(len(keys))]
            return np.array([i for x in each for i in x], np.uint32), np.array([len(x) for x in each], np.int32)
        sizes = self.size[slot][which]
        begin = self.at[slot][which]
        out = np.concatenate(([0], np.cumsum(sizes)))
        return self.ids[np.repeat(begin - out[:-1], sizes) + np.arange(out[-1])], sizes


def _flat(step: dict | None, inner: str) -> list[dict]:
    if not step:
        return []
    return [s for x in step[inner] for s in _flat(x, inner)] if step["type"] == "Sequence" else [step]


def _pattern(spec: dict) -> str:
    return spec["Regex"] if "Regex" in spec else regex.escape(spec["String"])


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _slices(column: pa.Array) -> Iterator[tuple[int, int]]:
    start, held = 0, 0
    for i, size in enumerate(pc.binary_length(column).fill_null(0).to_pylist()):
        if held and held + size > CHUNK_BYTES:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(column):
        yield start, len(column)


def encode(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """Per document: id, n_tokens, ids (array of int), packed_ids (binary, little-endian 32-bit), decoded."""
    path = path or vocabulary_path()
    key = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            for a, b in _slices(batch.column(1)):
                ids, before = coder.encode_all(batch.column(1).slice(a, b - a).to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(before, pa.int32()), pa.array(ids.astype(np.int32)))
                packed = pa.Array.from_buffers(pa.binary(), b - a, [
                    None, pa.py_buffer((4 * before).astype(np.int32)), pa.py_buffer(ids.astype("<u4")),
                ])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), pa.array(np.diff(before), pa.int64()),
                    lists, packed, coder.decode(lists),
                ], names=["id", "n_tokens", "ids", "packed_ids", "decoded"])
                del ids, before, lists, packed
            del batch
            tokens.give_back()

    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {key}, n_tokens long, ids array<int>, packed_ids binary, decoded string",
    )
    return out.withColumnRenamed("id", id_col)


def decode(rows: DataFrame, *, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """Per row: id, decoded, from an array of int."""
    path = path or vocabulary_path()
    key = rows.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), coder.decode(batch.column(1))], names=["id", "decoded"],
            )

    out = rows.select(F.col(id_col).alias("id"), F.col(ids_col).cast("array<int>").alias("ids")).mapInArrow(
        run, f"id {key}, decoded string",
    )
    return out.withColumnRenamed("id", id_col)

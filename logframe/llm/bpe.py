"""Exact byte-pair encoding in linear time by backtracking, and decoding by an offset table."""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Callable

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

# Words whose tokens a worker remembers at most besides those of one text, and pairs of tokens.
CACHE_WORDS = 500_000


def byte_alphabet() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = (b for b in range(256) if b not in set(plain))
    named = dict(zip(plain, map(chr, plain))) | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [named[b] for b in range(256)]


class Vocabulary:
    """Tokens, merges and text rules of a tokenizer file with BPE and word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        added = {token["content"]: token["id"] for token in spec["added_tokens"]}
        self.tokens = [""] * (max([*self.ids.values(), *added.values()]) + 1)
        for token, i in [*self.ids.items(), *added.items()]:
            self.tokens[i] = token
        self.added = added
        self.special = regex.compile("|".join(map(regex.escape, added)) or r"(?!)")
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.ascii_words, self.words = _word_patterns(split["pattern"]["Regex"])
        self.alphabet = byte_alphabet()

        # A token as a string of symbols: one character a byte, others for the last byte of a word.
        symbol = {c: chr(b) for b, c in enumerate(self.alphabet)}
        last = {c: chr(256 + b) for b, c in enumerate(self.alphabet)}

        def symbols(token: str) -> str:
            if self.end and token.endswith(self.end):
                body = token[: -len(self.end)]
                return "".join(symbol[c] for c in body[:-1]) + last[body[-1]]
            return "".join(symbol[c] for c in token)

        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        basic = [t for t in self.ids if len(symbols(t)) == 1]
        # Tokens in order of merging: basic ones first. Ranks, not ids, are compared.
        order = basic + [a + b for a, b in merges]
        rank = {token: i for i, token in enumerate(order)}
        self.rank_ids = [self.ids[t] for t in order]
        self.lengths = [len(symbols(t)) for t in order]
        self.halves = [(i, i) for i in range(len(basic))] + [(rank[a], rank[b]) for a, b in merges]
        # Which two neighbours merge, and into what: the pair-compatibility table's ground.
        self.merged = {pair: len(basic) + i for i, pair in enumerate(self.halves[len(basic) :])}
        self.finder = ahocorasick.Automaton()
        for i, token in enumerate(order):
            self.finder.add_word(symbols(token), i)
        self.finder.make_automaton()
        # For each token the longest token that it begins with, -1 if none.
        by_symbols = {symbols(t): i for i, t in enumerate(order)}
        self.shorter = [
            next((by_symbols[s[:n]] for n in range(len(s) - 1, 0, -1) if s[:n] in by_symbols), -1)
            for s in map(symbols, order)
        ]
        self.fits: dict[int, bool] = {}

    def compatible(self, one: int, two: int) -> bool:
        """Whether merging leaves two tokens side by side as they are.

        It does unless, on the way to them, their facing parts would have merged
        before the parts did with what they belong to. Answers are remembered.
        """
        pair = one << 32 | two
        bound, answer = len(self.halves), True
        while True:
            new = self.merged.get((one, two), bound)
            if new < bound:
                answer = False
                break
            # Undo the later of the two merges; it bounds which merge could have come between.
            if one > two:
                bound, half = one, self.halves[one][1]
                if half == one:
                    bound, half = two + 1, self.halves[two][0]
                    if half == two:
                        break
                    two = half
                else:
                    one = half
            else:
                bound, half = two + 1, self.halves[two][0]
                if half == two:
                    bound, half = one, self.halves[one][1]
                    if half == one:
                        break
                    one = half
                else:
                    two = half
        if len(self.fits) >= CACHE_WORDS:
            self.fits.clear()
        self.fits[pair] = answer
        return answer

    def encode_word(self, word: bytes) -> list[int]:
        """The ids that merging gives for one word.

        Tokens are chosen from the left, the longest match first. One that does
        not fit the token before, or ends where the rest is known to have no
        division, gives way to the next shorter one, and if there is none the
        token before is taken back. No place is tried from twice.
        """
        text = word.decode("latin-1")
        if self.end:
            text = text[:-1] + chr(256 + ord(text[-1]))
        n, lengths, fits, shorter = len(text), self.lengths, self.fits, self.shorter
        longest = [-1] * n
        for stop, token in self.finder.iter(text):  # at a start, later matches are longer
            longest[stop - lengths[token] + 1] = token
        dead = bytearray(n + 1)
        chosen: list[int] = []
        at, token, last = 0, longest[0], -1
        while at < n:
            while token >= 0:
                stop = at + lengths[token]
                if not dead[stop]:
                    if last < 0:
                        break
                    fit = fits.get(last << 32 | token)
                    if fit or (fit is None and self.compatible(last, token)):
                        break
                token = shorter[token]
            if token >= 0:
                chosen.append(token)
                at, last = stop, token
                token = longest[at] if at < n else -1
            else:
                if not chosen:
                    raise ValueError("the vocabulary lacks a basic token")
                dead[at] = 1
                gone = chosen.pop()
                at -= lengths[gone]
                last = chosen[-1] if chosen else -1
                token = shorter[gone]
        return [self.rank_ids[t] for t in chosen]

    def pieces(self, text: str) -> list[str | int]:
        """A text's words in order, normalised, with the ids of added tokens among them."""
        if text.isascii() and not self.special.search(text):
            return self.ascii_words.findall(text.lower())
        found, low = [], 0
        for match in self.special.finditer(text):
            found += self.words.findall(normal(text[low : match.start()]))
            found.append(self.added[match[0]])
            low = match.end()
        return found + self.words.findall(normal(text[low:]))


def _word_patterns(rule: str) -> tuple[re.Pattern, regex.Pattern]:
    r"""The file's pattern of words, for ASCII texts in lower case and for all.

    \s is Unicode's White_Space, of which Python has more. Letters and numbers
    are those of the regex module's Unicode version; characters that this and
    the tokenizer library's disagree on, of the newest scripts, may be divided
    differently.
    """
    in_ascii = rule.replace(r"\p{L}", "a-z").replace(r"[\p{N}]", "[0-9]").replace(r"\p{N}", "0-9")
    in_ascii = in_ascii.replace(r"[^\s", r"[^\t-\r ")
    return re.compile(in_ascii), regex.compile(rule.replace(r"[^\s", r"[^\p{White_Space}"))


def normal(text: str) -> str:
    """NFC, then lower case character by character (so a final sigma is like others)."""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


class OffsetTable:
    """Byte strings by number: all of them joined, and where each begins."""

    def __init__(self, strings: list[bytes]):
        self.data = np.frombuffer(b"".join(strings), dtype=np.uint8)
        self.sizes = np.array([len(s) for s in strings], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])[:-1]

    def joined(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The strings of the numbers one after the other, and where each ends."""
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        shift = self.starts[numbers] - (ends - sizes)
        return self.data[np.repeat(shift, sizes) + np.arange(total)], ends


class Codec:
    """Encodes and decodes texts, remembering words between batches of a worker."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.known: dict[str | int, bytes] = {}
        # Strings end in a space, which stands between tokens and is cut at the end of a text.
        self.words = OffsetTable([token.encode() + b" " for token in self.vocabulary.tokens])
        self.numbers = OffsetTable([b"%d " % i for i in range(len(self.vocabulary.tokens))])

    def encode(self, text: str | None) -> np.ndarray:
        pieces, known = self.vocabulary.pieces(text or ""), self.known
        new = set(pieces).difference(known)
        if len(known) + len(new) > CACHE_WORDS:
            known.clear()
            new = set(pieces)
        for piece in new:
            own = [piece] if isinstance(piece, int) else self.vocabulary.encode_word(piece.encode())
            known[piece] = np.array(own, dtype=np.int32).tobytes()
        ids = np.frombuffer(b"".join(map(known.__getitem__, pieces)), dtype=np.int32)
        if len(known) > CACHE_WORDS:  # one text with more words than are remembered
            known.clear()
        return ids

    def spelled(self, table: OffsetTable, ids: np.ndarray) -> bytes:
        """The strings of ids joined by single spaces, a part of the text at a time."""
        parts = [
            table.joined(ids[low : low + (1 << 20)])[0].tobytes() for low in range(0, len(ids), 1 << 20)
        ]
        return b"".join(parts)[:-1]

    def decode(self, ids: np.ndarray) -> str:
        return self.spelled(self.words, ids).decode()


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The worker's codec of a tokenizer file."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def encode(text: Column, path: str) -> Column:
    """The ids of a whole text as an array, as its tokenizer's own library gives them.

    Texts are cut at the added tokens of the file, normalised (NFC, lower case)
    and divided into words by its pattern; each word is divided into the tokens
    that merging would leave. NULL and texts without words have no ids. The
    file must be at ``path`` for every executor. Each text is encoded in the
    task that reads it.
    """
    return _column(path, lambda c, t: c.encode(t), "array<int>", pa.list_(pa.int32()))(text)


def decode(ids: Column, path: str) -> Column:
    """The tokens of ids joined by single spaces, special ones included; NULL is no ids."""
    known = lambda c, i: c.decode(np.array(i or [], dtype=np.int64))
    return _column(path, known, "string", pa.string())(ids)


def digest(text: Column, path: str) -> Column:
    """Of a whole text: how many ids, SHA-256 of them and of what they decode to.

    The ids are encoded, and the text decoded from them, as by ``encode`` and
    ``decode``; only digests leave the worker. ``ids_sha256`` is of the decimal
    ids joined by one space.
    """

    def told(c: Codec, value: str | None) -> dict:
        ids = c.encode(value)
        return {
            "n_tokens": len(ids),
            "ids_sha256": hashlib.sha256(c.spelled(c.numbers, ids)).hexdigest(),
            "decoded_sha256": hashlib.sha256(c.decode(ids).encode()).hexdigest(),
        }

    kind = pa.struct(
        [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    )
    return _column(
        path, told, "struct<n_tokens: bigint, ids_sha256: string, decoded_sha256: string>", kind
    )(text)


def _column(path: str, function: Callable, kind: str, arrow: pa.DataType) -> Callable[[Column], Column]:
    @F.arrow_udf(kind)
    def apply(column: pa.Array) -> pa.Array:
        own = codec(path)
        return pa.array([function(own, value.as_py()) for value in column], arrow)

    return apply

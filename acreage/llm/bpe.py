"""Byte-pair encoding and decoding by a trie of distinct words.

A word's encoding ends in one certain token, and what precedes that token is the encoding of the
shorter prefix. So the last token of every prefix is all that has to be known, and it follows
from the last tokens of shorter prefixes: among the vocabulary's tokens that end a prefix, exactly
one may stand beside the last token of the prefix before it. The distinct words of a batch are
walked as a trie, depth first, and a prefix that many words share is encoded once.

Two tokens may stand side by side if no merge reaches over their border while both are being
built. That is looked up among the few merges along the border instead of merging symbols.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreage.llm.common import small_batches

# Words whose encodings a Python worker remembers between batches.
REMEMBERED_WORDS = 800_000
# Characters of text whose words are one trie: the more there are, the more of them share prefixes.
CHARS_AT_ONCE = 4_000_000
# A longer text is cut at white space, which no token spans.
LONG_TEXT = 4_000_000

SPACE, DIGIT, LETTER, OTHER = range(4)
# Fixed values of the vocabulary file: what follows an apostrophe in a word of its own.
CONTRACTIONS = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")
# Added to a word's last symbol, which the vocabulary tells from the same symbol elsewhere.
LAST = 0x1000


@lru_cache(maxsize=1)
def code_point_kinds() -> np.ndarray:
    """The kind of each code point: white space, numbers, letters and anything else."""
    kinds = np.full(0x110000, OTHER, np.uint8)
    names = np.array([unicodedata.category(chr(c))[0] for c in range(0x110000)])
    kinds[names == "L"], kinds[names == "N"] = LETTER, DIGIT
    # Unicode's white space.
    kinds[[*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = SPACE
    return kinds


def byte_kinds() -> np.ndarray:
    """The kind of each byte of a text in ASCII."""
    kinds = np.full(128, OTHER, np.uint8)
    kinds[list(b"\t\n\v\f\r ")] = SPACE
    kinds[list(b"0123456789")] = DIGIT
    kinds[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = LETTER
    return kinds


class WordBPE:
    """A vocabulary with word ends, read from a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        vocabulary: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.tokens = [b""] * (max([*vocabulary.values(), *self.special.values()]) + 1)
        for token, number in (vocabulary | self.special).items():
            self.tokens[number] = token.encode()
        self.idbytes = [struct.pack("<I", n) for n in range(len(self.tokens))]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank: dict[tuple[int, int], int] = {}
        # For each token the edges it shows while it is built: (part, rank at which the part is merged away).
        self.right: dict[int, list[tuple[int, float]]] = {n: [(n, float("inf"))] for n in vocabulary.values()}
        self.left = {n: [(n, float("inf"))] for n in vocabulary.values()}
        self.beside: dict[int, bool] = {}
        parts = {}
        for rank, (a, b) in enumerate(merges):
            a_id, b_id = vocabulary[a], vocabulary[b]
            self.rank[a_id, b_id] = rank
            parts[vocabulary[a + b]] = (a_id, b_id, rank)
        reachable = set(vocabulary.values()) - set(parts)
        for number, (a, b, rank) in parts.items():
            if a in reachable and b in reachable and self._fits(a, b, but=rank):
                reachable.add(number)
                self.right[number] += [(b, rank), *self.right[b][1:]]
                self.left[number] += [(a, rank), *self.left[a][1:]]
        self.token_of = {self._marked(t): n for t, n in vocabulary.items() if n in reachable}
        self.begun = {t[:n] for t in self.token_of for n in range(len(t) + 1)}
        # States of the walk: the longest end of a prefix that a token begins with. For each the
        # states that follow, filled in as they are met, and the tokens that end there, longest first.
        self.state_of: dict[str, int] = {}
        self.state_text: list[str] = []
        self.following: list[dict[str, int]] = []
        self.ending: list[list[tuple[int, int]]] = []
        self._state("")
        visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
        hidden = [b for b in range(256) if b not in visible]
        self.shown = {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.known: dict[str, bytes] = {}
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.kinds = byte_kinds()
        self.spaced = pa.array([t.decode() + " " for t in self.tokens], pa.large_string())

    def _fits(self, a: int, b: int, but: int = -1) -> bool:
        """Whether no merge joins a part at the right edge of a to one at the left edge of b."""
        for x, x_gone in self.right[a]:
            for y, y_gone in self.left[b]:
                rank = self.rank.get((x, y))
                if rank is not None and rank != but and rank < x_gone and rank <= y_gone:
                    return False
        return True

    def _marked(self, token: str) -> str:
        """A token's text, the last symbol of one that ends a word told from others."""
        if not token.endswith(self.end) or token == self.end:
            return token
        text = token.removesuffix(self.end)
        return text[:-1] + chr(ord(text[-1]) + LAST)

    def _state(self, text: str) -> int:
        state = self.state_of.get(text)
        if state is None:
            state = self.state_of[text] = len(self.state_text)
            self.state_text.append(text)
            self.following.append({})
            ends = ((self.token_of.get(text[cut:]), len(text) - cut) for cut in range(len(text)))
            self.ending.append([(token, length) for token, length in ends if token is not None])
        return state

    def _next(self, state: int, symbol: str) -> int:
        text = self.state_text[state] + symbol
        while text not in self.begun:
            text = text[1:]
        found = self.following[state][symbol] = self._state(text)
        return found

    def encode_words(self, words: Iterable[str]) -> dict[str, bytes]:
        """The ids of each word, as little-endian unsigned 32-bit integers.

        Sorted words are a depth-first walk of their trie: what a word shares with the one before
        it is on the stack already. A word that is a token needs no walk.
        """
        out, symbols = {}, []
        for text in words:
            word = self._symbols(text)
            word = word[:-1] + chr(ord(word[-1]) + LAST)
            token = self.token_of.get(word)
            if token is None:
                symbols.append((word, text))
            else:
                out[text] = self.idbytes[token]
        symbols.sort()
        following, ending, beside, idbytes = self.following, self.ending, self.beside, self.idbytes
        # For each prefix on the way to the present word: its state, its last token and its ids.
        states, last, encoded, before = [0], [0], [b""], ""
        for word, text in symbols:
            shared, most = 0, min(len(word), len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del states[shared + 1 :], last[shared + 1 :], encoded[shared + 1 :]
            state, depth = states[shared], shared
            for symbol in word[shared:]:
                depth += 1
                after = following[state].get(symbol)
                state = self._next(state, symbol) if after is None else after
                for token, length in ending[state]:
                    if length == depth:
                        break
                    key = last[depth - length] << 20 | token
                    fits = beside.get(key)
                    if fits is None:
                        fits = beside[key] = self._fits(last[depth - length], token)
                    if fits:
                        break
                else:
                    raise ValueError(f"the vocabulary has no token for a symbol of {text!r}")
                states.append(state)
                last.append(token)
                encoded.append(encoded[depth - length] + idbytes[token])
            out[text] = encoded[-1]
            before = word
        return out

    def _symbols(self, word: str) -> str:
        if word.isascii() and word.isprintable() and " " not in word:
            return word
        return "".join([self.shown[b] for b in word.encode()])

    def normalised(self, text: str) -> str:
        if text.isascii():
            return text.lower()
        # Lower case is taken letter by letter: a final sigma is not told from others.
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def parts(self, text: str) -> Iterator[str | bytes]:
        """Normalised stretches of bounded length of a text, and the ids of special tokens between them."""
        for part in self.special_pattern.split(text) if "<|" in text else [text]:
            if part in self.special:
                yield self.idbytes[self.special[part]]
                continue
            start = 0
            while len(part) - start > LONG_TEXT:
                cut = max(part.rfind(" ", start, start + LONG_TEXT), part.rfind("\n", start, start + LONG_TEXT))
                if cut <= start:
                    break
                yield self.normalised(part[start:cut])
                start = cut
            yield self.normalised(part[start:])

    def ids_of(self, words: list[str]) -> list[bytes]:
        """The ids of words, most of which have been met before."""
        ids = list(map(self.known.get, words))
        fresh = {w for w, known in zip(words, ids) if known is None}
        if not fresh:
            return ids
        if len(self.known) > REMEMBERED_WORDS:
            # What this batch has met again is likely to be met once more.
            self.known = {w: known for w, known in zip(words, ids) if known is not None}
        self.known.update(self.encode_words(fresh))
        return list(map(self.known.__getitem__, words))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers; nothing for NULL."""
        plain: list[tuple[list[str], list[tuple[int, int]]]] = [([], []), ([], [])]
        out: list[list[bytes]] = [[] for _ in texts]
        for place, text in enumerate(texts):
            for part in self.parts(text) if text else ():
                if isinstance(part, str):
                    # ASCII is told apart by byte, anything else by code point.
                    parts, places = plain[not part.isascii()]
                    parts.append(part)
                    places.append((place, len(out[place])))
                    part = b""
                out[place].append(part)
        for (parts, places), by_byte in zip(plain, (True, False)):
            for (place, at), ids in zip(places, self.encode_plain(parts, by_byte)):
                out[place][at] = ids
        return [b"".join(ids) for ids in out]

    def encode_plain(self, texts: list[str], by_byte: bool) -> list[bytes]:
        """The same for normalised texts without special tokens.

        All texts are cut into words at once, where the kind of what they consist of changes; each
        distinct word is encoded once, and the ids are laid out by index.
        """
        if not texts:
            return []
        column = pa.array(texts, pa.large_string())
        _, offsets, content = column.buffers()
        ends = np.frombuffer(offsets, np.int64)[: len(texts) + 1]
        if not ends[-1]:
            return [b""] * len(texts)
        raw = np.frombuffer(content, np.uint8)[: ends[-1]]
        if by_byte:
            kinds, firsts, text_begins = self.kinds[raw], None, ends
        else:
            kinds = code_point_kinds()[np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")]
            firsts = np.append(np.flatnonzero(raw & 0xC0 != 0x80), len(raw))
            text_begins = np.searchsorted(firsts, ends)
        begins = np.empty(len(kinds) + 1, bool)
        begins[1:-1] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == DIGIT)
        begins[text_begins] = True
        self._contractions(raw, firsts, begins, text_begins)
        starts = np.flatnonzero(begins[:-1])
        cuts = np.append(starts, len(kinds))
        cuts = cuts if firsts is None else firsts[cuts]
        words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(cuts.astype(np.int64)), content).dictionary_encode()
        codes = words.indices.to_numpy()
        distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        blank = np.zeros(len(distinct), bool)
        blank[codes[kinds[starts] == SPACE]] = True
        encoded = np.array([b""] * len(distinct), object)
        encoded[~blank] = self.ids_of([w for w, b in zip(distinct, blank.tolist()) if not b])
        sizes = np.fromiter(map(len, encoded), np.int64, len(encoded)) // 4
        flat = np.frombuffer(b"".join(encoded), "<u4")
        each = sizes[codes]
        laid = np.concatenate([[0], np.cumsum(each)])
        at = np.repeat((np.cumsum(sizes) - sizes)[codes] - laid[:-1], each) + np.arange(laid[-1])
        ids = flat[at].tobytes()
        bounds = (laid[np.searchsorted(starts, text_begins)] * 4).tolist()
        return [ids[a:b] for a, b in zip(bounds, bounds[1:])]

    def _contractions(self, raw: np.ndarray, firsts: np.ndarray | None, begins: np.ndarray, text_begins: np.ndarray) -> None:
        """Join an apostrophe that begins a word with what makes a contraction of it. What follows
        the contraction is a new word."""
        quotes = np.flatnonzero(raw == 39)
        if firsts is not None:
            quotes = np.searchsorted(firsts, quotes)
        quotes = quotes[begins[quotes]]
        if not len(quotes):
            return
        at = (lambda i: raw[i]) if firsts is None else (lambda i: raw[firsts[i]])
        # Where the text of each quote ends.
        end = text_begins[np.searchsorted(text_begins, quotes, "right")]
        taken = np.zeros(len(quotes), bool)
        for letters in CONTRACTIONS:
            fits = ~taken & (quotes + len(letters) < end)
            for i, letter in enumerate(letters, 1):
                fits &= at(np.minimum(quotes + i, end - 1)) == letter
            taken |= fits
            begins[quotes[fits] + 1] = False
            begins[quotes[fits] + 1 + len(letters)] = True

    def decode(self, ids: list[bytes | None]) -> list[str]:
        """The tokens of each row's ids with a blank between them, as the vocabulary file has no
        decoder; empty for NULL."""
        laid = np.cumsum([0, *(len(i or b"") // 4 for i in ids)])
        tokens = self.spaced.take(pa.array(np.frombuffer(b"".join(i or b"" for i in ids), "<u4")))
        _, offsets, content = tokens.buffers()
        if not laid[-1]:
            return [""] * len(ids)
        bounds = np.frombuffer(offsets, np.int64)[laid].tolist()
        view = memoryview(content)
        return [str(view[a : max(a, b - 1)], "utf-8") for a, b in zip(bounds, bounds[1:])]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> WordBPE:
    """The vocabulary, read once in each Python worker."""
    return WordBPE(path)


def encode(
    docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), decoded: bool = False
) -> DataFrame:
    """``keep`` and ``ids``, the binary ids of each row's whole text; none for NULL and empty texts.

    Rows are encoded where they are read; only these columns leave the task. ``path`` is a
    vocabulary file that every executor can open, such as one of an installed package. With
    ``decoded`` the ids are decoded again in the same worker, into a column of that name.
    """
    rows = docs.select(*keep, F.col(text).cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in small_batches(batches, "_text", CHARS_AT_ONCE):
            ids = bpe.encode(batch.column("_text").to_pylist())
            columns = [*(batch.column(c) for c in keep), pa.array(ids, pa.binary())]
            if decoded:
                columns.append(pa.array(bpe.decode(ids), pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "ids", "decoded"][: len(columns)])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1])
    return rows.mapInArrow(run, f"{kinds}, ids binary" + ", decoded string" * decoded)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The rows with ``decoded`` in addition, the text of ``ids``; empty for NULL."""
    names = encoded.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in small_batches(batches, "ids"):
            texts = bpe.decode(batch.column("ids").to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*names, "decoded"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(run, f"{kinds}, decoded string")

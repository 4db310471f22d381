"""BPE encoding and decoding by prefix-sharing trie traversal.

The distinct words of a batch form a trie (here: their sorted order, in which a word shares a path with the one before
it). The state of a trie node is the last token of the encoding of its prefix. A BPE encoding of a prefix is the encoding
of a shorter prefix and one more token; the token is the one suffix of the prefix that is in the vocabulary and may
follow the shorter prefix's last token. So each node needs its ancestors' states only, a shared prefix is encoded once,
and a word's ids are read back along the states.

Texts are normalised as the tokenizer file says: NFC, white space, lower case; its special tokens' strings give their
ids. Null counts as empty. Everything a worker keeps between batches is bounded. Each row is encoded by itself, so repeated
rows have equal ids and an empty table gives an empty one; columns that are kept may have any names (see map_text).
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterable
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ._common import map_text, worker_cache

END = "</w>"
assert sys.byteorder == "little" and array("I").itemsize == 4  # ids travel as such bytes
#: Distinct white-space separated chunks of which a worker keeps the ids, and their characters; then it starts anew.
CACHE_WORDS, CACHE_CHARS = 700_000, 12_000_000
#: Pairs of tokens of which a worker keeps whether they may stand side by side.
CACHE_PAIRS = 1_000_000


def byte_chars() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, extra = [], 256
    for b in range(256):
        if b in plain:
            out.append(chr(b))
        else:
            out.append(chr(extra))
            extra += 1
    return out


class WordBpe:
    """A BPE vocabulary with word ends, read from a tokenizers JSON file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("end_of_word_suffix") != END or spec.get("decoder") is not None:
            raise ValueError(f"{path}: only BPE vocabularies with word ends and no decoder are supported")
        self.vocab: dict[str, int] = model["vocab"]
        self.text_of = {i: t for t, i in self.vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.text_of.update({i: t for t, i in self.special.items()})
        self.rank: dict[int, int] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            left, right, whole = self.vocab[a], self.vocab[b], self.vocab[a + b]
            self.merged[left, right] = rank
            self.rank[whole] = rank
            self.halves[whole] = (left, right)
        # Tokens by their symbols: an inner token by its characters, one at a word's end apart.
        self.inner = {t: i for t, i in self.vocab.items() if not t.endswith(END)}
        self.final = {t[: -len(END)]: i for t, i in self.vocab.items() if t.endswith(END) and len(t) > len(END)}
        self.length = {i: len(t) for t, i in self.inner.items()} | {i: len(t) for t, i in self.final.items()}
        self.inner_sizes, self.final_sizes = self._sizes(self.inner), self._sizes(self.final)
        self.may_follow: dict[tuple[int, int], bool] = {}
        self.bytes = byte_chars()
        self.pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.specials = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    @staticmethod
    def _sizes(table: dict[str, int]) -> dict[str, tuple[int, ...]]:
        """For the last three characters (or all of fewer): the sizes of the tokens that end so, the largest first."""
        found: dict[str, set[int]] = {}
        for t in table:
            found.setdefault(t[-3:], {1, 2}).add(len(t))
        return {t: tuple(sorted(x, reverse=True)) for t, x in found.items()}

    def follows(self, a: int, b: int) -> bool:
        """Whether BPE leaves tokens a and b apart when b comes right after a.

        Undoes merges from the latest one: as long as neither the two sides' touching tokens merge earlier than the
        merge that is undone, nothing crosses the border. On the right side a merge of the same rank comes first on the
        left, so it may be one rank later.
        """
        key = (a, b)
        known = self.may_follow.get(key)
        if known is not None:
            return known
        rank, halves, merged = self.rank, self.halves, self.merged
        bound, ok = len(rank) * 2 + 2, True  # in half ranks: 2r for the left side's merge r, 2r + 1 for the right side's
        while True:
            r = merged.get((a, b))
            if r is not None and 2 * r < bound:
                ok = False
                break
            ra, rb = rank.get(a, -1), rank.get(b, -1)
            if ra < 0 and rb < 0:
                break
            if ra > rb:
                bound, a = 2 * ra, halves[a][1]
            else:
                bound, b = 2 * rb + 1, halves[b][0]
        if len(self.may_follow) >= CACHE_PAIRS:
            self.may_follow.clear()
        self.may_follow[key] = ok
        return ok

    def _step(self, table: dict[str, int], sizes: dict[str, tuple[int, ...]], word: str, depth: int, last: list[int]) -> int:
        """The last token of the encoding of word[:depth], given the states of the shorter prefixes."""
        known = self.may_follow
        for size in sizes.get(word[depth - 3 : depth] if depth > 3 else word[:depth], (2, 1)):
            start = depth - size
            if start < 0:
                continue
            token = table.get(word[start:depth])
            if token is not None:
                if not start:
                    return token
                key = (last[start], token)
                ok = known.get(key)
                if ok or ok is None and self.follows(*key):
                    return token
        raise ValueError(f"{word!r} can't be encoded")

    def encode_words(self, words: Iterable[str]) -> dict[str, list[int]]:
        """The ids of each distinct word (in byte characters), by one walk over the trie that they form."""
        out: dict[str, list[int]] = {}
        last, have, before = [-1], 0, ""  # last[d]: state of the node at depth d of the present path; have: how deep they are known
        inner, final, length, step, inner_sizes, final_sizes = self.inner, self.final, self.length, self._step, self.inner_sizes, self.final_sizes
        for word in sorted(words):
            shared, most = 0, min(have, len(word) - 1)
            if word[:most] == before[:most]:
                shared = most
            else:
                while word[shared] == before[shared]:
                    shared += 1
            del last[shared + 1 :]
            for depth in range(shared + 1, len(word)):
                last.append(step(inner, inner_sizes, word, depth, last))
            have, before = len(word) - 1, word
            depth, token, ids = len(word), step(final, final_sizes, word, len(word), last), []
            while True:
                ids.append(token)
                depth -= length[token]
                if not depth:
                    break
                token = last[depth]
            out[word] = ids[::-1]
        return out


def lowered(text: str) -> str:
    """NFC and each character's lower case by itself (a sigma at a word's end stays the common one)."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
        if "Σ" in text:
            text = text.replace("Σ", "σ")
    return text.lower()


#: Characters that str.split() takes for white space and the tokenizer does not.
ODD_SPACE = re.compile("[\x1c-\x1f]")
WHITE = re.compile(r"[^\S\x1c-\x1f]+")
#: The pre-tokenizer's pattern that chunks of lower-case ASCII are cut by without the library.
KNOWN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ASCII_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")


class TextEncoder:
    """Texts to ids, with the ids of the chunks seen so far. One instance for each worker and vocabulary.

    Chunks are cut into words by the tokenizer file's pre-tokenizer; new words are encoded by the trie, or (library) by the
    tokenizers library.
    """

    def __init__(self, path: str, library: bool = False):
        self.bpe = WordBpe(path)
        self.library = Library(path, self.bpe)
        self.library_words = library
        self.assigned: set[str] = set()  # characters seen so far that Python's Unicode tables know
        self.known: dict[str, bytes] = {}
        self.chars = 0  # of the chunks in known
        self.special = {t: array("I", [i]).tobytes() for t, i in self.bpe.special.items()}

    def learn(self, fresh: set[str]) -> None:
        """Encodes chunks (lower case, without white space) that have no ids yet. A chunk is one or more of the pre-tokenizer's words."""
        known = self.known
        words, ended, several = [], [], []
        for chunk in fresh:
            if chunk.isalpha():
                words.append(chunk)
            elif chunk[-1] in ".,;:!?" and chunk[:-1].isalpha():
                ended.append(chunk)
            else:
                several.append((chunk, self._pieces(chunk)))
        unseen = {c[:-1] for c in ended}.difference(known)
        unseen.update(words)
        unseen.update(c[-1] for c in ended if c[-1] not in known)
        unseen.update(p for _, pieces in several for p in pieces if p not in known)
        self._encode(unseen)
        for chunk in ended:
            known[chunk] = known[chunk[:-1]] + known[chunk[-1]]
        for chunk, pieces in several:
            known[chunk] = b"".join([known[p] for p in pieces])

    def _encode(self, unseen: set[str]) -> None:
        """Encodes words of the pre-tokenizer."""
        bpe, table, known = self.bpe, self.bpe.bytes, self.known
        if self.library_words:
            plain = [w for w in unseen if w.isalpha() and (w.isascii() or unicodedata.is_normalized("NFC", w))]
            self.library.encode_words(plain, known)
            unseen = unseen.difference(plain)
        words = {w if w.isascii() and w.isprintable() else "".join([table[b] for b in w.encode()]): w for w in unseen}
        for mapped, ids in bpe.encode_words(words).items():
            known[words[mapped]] = array("I", ids).tobytes()

    def _pieces(self, chunk: str) -> list[str]:
        if chunk.isascii() and self.bpe.pattern == KNOWN_PATTERN:
            return ASCII_PIECES.findall(chunk)
        return self.library.pieces(chunk)

    def _lowered(self, text: str) -> str:
        if not text.isascii():
            fresh = set(text).difference(self.assigned)
            newer = {c for c in fresh if unicodedata.category(c) == "Cn"}
            self.assigned |= fresh - newer
            if newer:  # the tokenizer's tables may know them as letters, so it must see the text itself
                return self.library.tokenizer.normalizer.normalize_str(text)
        return lowered(text)

    def split(self, text: str) -> list[str]:
        return [c for c in WHITE.sub(" ", text).split(" ") if c] if ODD_SPACE.search(text) else text.split()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Each text's ids, as little-endian unsigned 32-bit numbers."""
        if len(self.known) > CACHE_WORDS or self.chars > CACHE_CHARS:
            self.known.clear()
            self.chars = 0
        specials, rows = self.bpe.specials, []
        for text in texts:
            if text and specials and "<|" in text and specials.search(text):
                rows.append([part if k % 2 else self.split(self._lowered(part)) for k, part in enumerate(specials.split(text))])
            else:
                rows.append(self.split(self._lowered(text or "")))
        plain = [r for r in rows if not r or type(r[0]) is str] + [part for r in rows if r and type(r[0]) is list for part in r[::2]]
        fresh = set(chain.from_iterable(plain)).difference(self.known)
        self.chars += sum(map(len, fresh))
        self.learn(fresh)
        get, join = self.known.__getitem__, b"".join
        return [join(map(get, r)) if not r or type(r[0]) is str else join(self.special[p] if k % 2 else join(map(get, p)) for k, p in enumerate(r)) for r in rows]


class Library:
    """The tokenizers library on many words at once: one text of them, cut where a token ends a word."""

    def __init__(self, path: str, bpe: WordBpe):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.ends = np.zeros(max(bpe.text_of) + 1, bool)
        self.ends[[i for i, t in bpe.text_of.items() if t.endswith(END)]] = True

    def pieces(self, chunk: str) -> list[str]:
        """The pre-tokenizer's words of a chunk."""
        return [chunk[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(chunk)]

    def encode_words(self, words: list[str], known: dict[str, bytes]) -> None:
        """Puts each word's ids into known; words are of letters only, lower case and NFC."""
        for start in range(0, len(words), 20_000):
            part = words[start : start + 20_000]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            stops = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
            if len(stops) != len(part):
                raise ValueError("the vocabulary doesn't end each word once")
            raw = ids.tobytes()
            known.update(zip(part, [raw[a:b] for a, b in zip([0, *stops], stops, strict=False)], strict=True))


def encoder(path: str, library: bool = False) -> TextEncoder:
    """The worker's encoder for this vocabulary file; with the library's encoding of new words, or the trie's."""
    known = worker_cache(f"bpe {path} {library}")
    if not known:
        known["encoder"] = TextEncoder(path, library)
    return known["encoder"]


def list_array(parts: list[bytes]) -> pa.ListArray:
    """Arrow lists of int32 from each row's bytes, without a Python object for each number."""
    offsets = np.zeros(len(parts) + 1, "<i4")
    np.cumsum([len(p) >> 2 for p in parts], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(parts), "<i4")))


def encode(df: DataFrame, path: str, keep: list[str], text_col: str = "text") -> DataFrame:
    """keep, ids array<int>: the token ids of each whole text (null: none)."""
    return map_text(df, keep, text_col, [("ids", "array<int>")], lambda texts: [list_array(encoder(path).encode(texts))])


def decode(ids: list[int], path: str) -> str:
    """What the tokenizer's decode gives for ids, special tokens included: without a decoder, token texts with a space between."""
    names = encoder(path).bpe.text_of
    return " ".join(names[i] for i in ids if i in names)


def encode_decode(df: DataFrame, path: str, keep: list[str], text_col: str = "text") -> DataFrame:
    """keep, ids array<int>, decoded string: encoded and decoded in one pass over the texts."""

    def kernel(texts):
        e = encoder(path)
        rows = e.encode(texts)
        names = e.bpe.text_of
        return [list_array(rows), pa.array([" ".join(map(names.__getitem__, np.frombuffer(r, "<u4").tolist())) for r in rows], pa.string())]

    return map_text(df, keep, text_col, [("ids", "array<int>"), ("decoded", "string")], kernel)

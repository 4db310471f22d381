"""Text rules that are state machines: plain Python on one value, and their Arrow-batched columns.

Only what no built-in expression says is here; each kernel is a pure function, so that it is tested without Spark.
"""

from __future__ import annotations

import ctypes
import gc
import re
import unicodedata
from collections.abc import Callable
from difflib import SequenceMatcher

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def column(f: Callable, kind: str, *cols: Column) -> Column:
    """f over columns, in Arrow batches. f gets None for null."""

    def rows(series) -> list:
        return [f(*[None if x is None or (isinstance(x, float) and x != x) else x for x in row]) for row in zip(*series, strict=True)]

    if kind.startswith("struct"):

        @F.pandas_udf(kind)
        def structs(*series: pd.Series) -> pd.DataFrame:
            return pd.DataFrame(rows(series), dtype=object)

        return structs(*cols)

    @F.pandas_udf(kind)
    def values(*series: pd.Series) -> pd.Series:
        return pd.Series(rows(series), dtype=object)

    return values(*cols)


def release() -> None:
    """Gives memory that a worker has freed back to the system: workers are used again by later stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def strip_gloss(name: str | None, gloss: str, parts: frozenset[str]) -> str:
    """The name without spelling notes: a word that `gloss` matches starts one, a word of `parts` ends it."""
    out, inside = [], False
    for word in (name or "").split():
        if re.match(gloss, word):
            inside = True
        elif not inside or word in parts:
            inside = False
            out.append(word)
    return " ".join(out)


def last_name(text: str | None, separators: frozenset[str], least: int = 2, most: int = 40) -> str | None:
    """What follows the last separator that a plausible name follows, going back from the end."""
    words = (text or "").split()
    for i in range(len(words) - 1, -1, -1):
        if words[i].strip(",.;:") in separators:
            name = " ".join(words[i + 1 :]).strip(" ,.;:")
            if least <= len(name) <= most and any(c.isalpha() for c in name):
                return name
    return None


def name_before(words: list[str] | None, at: int, own: frozenset[str] | set[str]) -> str:
    """The words before place `at`, as far back as they are names of the record's own chain."""
    start = at
    while start > 0 and words[start - 1] in own:
        start -= 1
    return " ".join((words or [])[start:at])


def is_nfc(text: str | None) -> bool:
    return text is None or unicodedata.is_normalized("NFC", text)


def letter_ratio(a: str | None, b: str | None) -> float:
    """Share of letters in matching blocks, 0 to 1."""
    return SequenceMatcher(None, a or "", b or "", autojunk=False).ratio()


def chain_names(text: str | None, separators: frozenset[str], drop: frozenset[str], turn: str, most: int = 9) -> list[str]:
    """The names of a chain: after its last turn, between separators, without those that are dropped or too long."""
    part = re.split(turn, f" {text or ''} ")[-1]
    out, now = [], []
    for word in [*re.split(r"[\s,:.]+", part), None]:
        if word is None or word in separators:
            if now and len(now) <= most and " ".join(now) not in drop:
                out.append(" ".join(now))
            now = []
        elif word:
            now.append(word)
    return out


def dictionary_entry(text: str | None, ranks: list[tuple[int, str]], cut: str, codes: str, expand: dict[str, str]) -> dict:
    """Number, name, grade, rank and codes of a dictionary entry: the earliest grade phrase counts; codes stand at the end."""
    m = re.match(r"\s*(\d+)\s+(.*)", text or "", re.S)
    if not m:
        return {"no": None, "name": None, "grade": None, "rank": None, "codes": None}
    body, best = m[2], None
    for rank, pattern in ranks:
        g = re.search(pattern, body)
        if g and (best is None or g.start() < best[0]):
            best = (g.start(), rank, g[0])
    ends = [x for x in (best[0] if best else None, body.find(cut)) if x is not None and x > 0]
    found = {c for w in body.split()[-4:] if re.fullmatch(f"[{codes}]{{1,3}}", w) for c in w}
    found |= {c for k, v in expand.items() if k in found for c in v}
    return {"no": int(m[1]), "name": body[: min(ends)].strip() if ends else body.strip(), "grade": best[2] if best else None, "rank": best[1] if best else None, "codes": "".join(sorted(found))}


def place(rows: list[tuple], least: int = 2, sure: int = 4, near: tuple[int, int] = (-20, 60)) -> list[tuple]:
    """Where each record of a work stands, in order: (record, passage, how, hits).

    A row is (record, hits, heading): hits are mappings of g (group), n (number), passage, head and hits, the heading is a
    mapping of g, n and passage, or None. See operators.passages.placed for the rules.
    """
    out, now = [], None
    for record, hits, heading in rows:
        by = {h["passage"]: h for h in hits}
        best = min((h for h in hits if h["head"] >= least), key=lambda h: (-h["head"], h["g"], h["n"]), default=None)
        if heading is not None and heading == heading:
            now = (heading["g"], heading["n"], heading["passage"])
            out.append((record, now[2], "heading", by[now[2]]["hits"] if now[2] in by else 0))
        elif best is not None and (now is None or best["head"] >= sure or (best["g"] == now[0] and near[0] <= best["n"] - now[1] <= near[1])):
            now = (best["g"], best["n"], best["passage"])
            out.append((record, now[2], "lemma", best["hits"]))
        elif now is not None:
            out.append((record, now[2], "continues", by[now[2]]["hits"] if now[2] in by else 0))
        rest = sorted((h for h in hits if h["hits"] >= least and (now is None or h["passage"] != now[2])), key=lambda h: (-h["hits"], h["passage"]))
        out += [(record, h["passage"], "cited", h["hits"]) for h in rest]
    return out


def clean_layer(text: str | None, glyphs: dict[str, str], doubled: str = "", direction: str = "\u200e\u200f\u202a\u202b\u202c\u202d\u202e") -> str:
    """A text layer's glyph codes as letters, without doubled glyphs and direction marks, compatibility forms undone, NFC."""
    table = {ord(k): v for k, v in glyphs.items()} | {ord(c): None for c in direction}
    out = (text or "").translate(table)
    for c in doubled:
        out = re.sub(f"{re.escape(c)}{{2,}}", c, out)
    return unicodedata.normalize("NFC", unicodedata.normalize("NFKC", out))

"""Personal data: base patterns, and a character BiLSTM-CRF tagger that adds to them.

The base patterns find e-mail addresses, IPv4 addresses, card numbers and telephone numbers. The tagger is trained in numpy
from labelled spans: texts with their base spans, and such texts with made-up values put in, labelled where they stand.
Some of those have forms that the base patterns miss (telephone numbers without a plus sign, cards beside other numbers,
e-mail addresses with `(at)`, IPv6), and some are numbers of other kinds (dates, versions, prices), which are labelled
outside.

Every whole text is tiled by overlapping windows of WINDOW characters, one each STRIDE. A window without a digit, `@`,
`(at)` or `[at]` can hold no valid span, so its characters are known to be outside, and its scores aren't computed. A
character's label scores are the mean of its windows', weighted by how far inside each it lies; then one Viterbi pass over
each stretch of scored windows decides, so that windows never contradict each other (a stretch of more than BLOCK
characters is decoded in parts that overlap by LAG, which ends long before memory does). A decoded span is added if it is
valid for its kind, no letter or digit stands at its ends, and it touches no base span.

Spans are in code points, end exclusive, by kind as listed in KINDS and then start; base spans of different kinds may
overlap. Null texts count as empty, repeated rows have equal spans each, an empty table gives an empty one, and kept columns
may have any names (see map_text).
"""

from __future__ import annotations

import ipaddress
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import column, durable, hash_order, map_text
from .bilstm_crf import Tagger, classes

KINDS = ["email", "ip", "card", "phone"]
WINDOW, STRIDE = 64, 32
#: Characters of a stretch that are decoded at once, and by how many such parts overlap on either side.
BLOCK, LAG = 16_384, 512
#: Texts that the tagger learns from at most (chosen by a hash of the id), windows of all of them together (by a hash of
#: the window), and windows with made-up values.
MAX_TEXTS, MAX_WINDOWS, MADE_UP = 800, 1000, 2000
SEED = 9
# The base patterns.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")  # a run of digits that doesn't start a match has none inside
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_TRIGGER = re.compile(r"[0-9@]+|[(\[]at[)\]]")
# What a span may look like that the tagger adds.
_HIDDEN_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+ ?[(\[]at[)\]] ?[A-Za-z0-9-]+(?: ?(?:\.|[(\[]dot[)\]]) ?[A-Za-z0-9-]+)+")
_LOOSE_CARD = re.compile(r"[0-9](?:[ .-]?[0-9]){12,18}")
_LOOSE_PHONE = re.compile(r"\+?(?:[0-9]|\([0-9]{1,5}\))(?:[ ./-]{0,2}(?:[0-9]|\([0-9]{1,5}\)))*")
SPANS = "array<struct<kind:string,start:int,end:int>>"


def luhn(digits: str) -> bool:
    odd = [int(d) for d in digits[::-1]]
    return (sum(odd[::2]) + sum(d * 2 - 9 * (d > 4) for d in odd[1::2])) % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def valid(kind: str, text: str) -> bool:
    """Whether a match of the kind's pattern counts."""
    digits = _only_digits(text)
    if kind == "ip":
        parts = text.split(".")
        return len(parts) == 4 and all(p.isdecimal() and len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in parts)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 9 <= len(digits) <= 15
    local, _, domain = text.partition("@")
    return bool(local) and _DOMAIN.fullmatch(domain) is not None


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """Leftmost non-overlapping matches of each kind, without those that fail, by kind and start."""
    out: list[tuple[str, int, int]] = []
    if not text:
        return out
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            end = m.end()
            out.append(("email", start, end))
        at = text.find("@", max(at + 1, end))
    if _TRIGGER.search(text):
        for kind, pattern in (("ip", _IP), ("card", _CARD), ("phone", _PHONE)):
            out += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if valid(kind, m.group())]
    return out


def valid_added(kind: str, text: str) -> bool:
    """Whether a span that the tagger found counts: the base form of its kind, or one of the forms that those patterns miss."""
    if valid(kind, text) and (kind != "phone" or text[:1] == "+"):
        return True
    if kind == "email":
        return _HIDDEN_EMAIL.fullmatch(text) is not None
    if kind == "card":
        return _LOOSE_CARD.fullmatch(text) is not None and luhn(_only_digits(text))
    if kind == "phone":
        return _LOOSE_PHONE.fullmatch(text) is not None and 9 <= len(_only_digits(text)) <= 15 and (text[0] in "+0(" or sum(not c.isdigit() for c in text) >= 2)
    try:
        return ":" in text and ipaddress.IPv6Address(text) is not None
    except ValueError:
        return False


def scored(text: str) -> list[tuple[int, int]]:
    """The stretches of a text that windows with a trigger cover; each starts at a multiple of STRIDE."""
    out: list[list[int]] = []
    for m in _TRIGGER.finditer(text):
        # The windows that hold a character of the trigger start after m.start() - WINDOW and before m.end().
        a = max(0, (m.start() - WINDOW) // STRIDE + 1) * STRIDE
        b = min(len(text), (m.end() - 1) // STRIDE * STRIDE + WINDOW)
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _windows(length: int) -> range:
    """Where the windows of a stretch start; the last one may reach over its end."""
    return range(0, max(1, length - WINDOW + STRIDE), STRIDE)


_INSIDE = np.minimum(np.arange(WINDOW), np.arange(WINDOW)[::-1]).astype(np.float32) + 1


@dataclass
class Model:
    tagger: Tagger

    def labels(self, pieces: list[str]) -> list[np.ndarray]:
        """The labels of pieces of text, each of at most BLOCK and two LAG characters."""
        codes = [classes(p) for p in pieces]
        places = [(k, s) for k, c in enumerate(codes) for s in _windows(len(c))]
        x = np.full((len(places), WINDOW), CLASS_PAD, np.int64)
        for row, (k, s) in zip(x, places, strict=True):
            piece = codes[k][s : s + WINDOW]
            row[: len(piece)] = piece
        sums = [np.zeros((len(c), self.tagger.tags), np.float32) for c in codes]
        weight = [np.zeros(len(c), np.float32) for c in codes]
        for at in range(0, len(x), 256):
            for (k, s), e in zip(places[at : at + 256], self.tagger.emissions(x[at : at + 256]), strict=True):
                n = min(WINDOW, len(codes[k]) - s)
                sums[k][s : s + n] += e[:n] * _INSIDE[:n, None]
                weight[k][s : s + n] += _INSIDE[:n]
        return [self.tagger.viterbi(total / w[:, None]) for total, w in zip(sums, weight, strict=True)]

    def added(self, texts: list[str | None], base: list[list[tuple[str, int, int]]]) -> list[list[tuple[str, int, int]]]:
        """The spans that the tagger adds to each text's base spans."""
        out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
        stretches = [(i, a, b) for i, t in enumerate(texts) if t for a, b in scored(t)]
        found = [np.zeros(b - a, np.int8) for _, a, b in stretches]
        group: list[tuple[int, int, int, int, int]] = []  # stretch, the part to decode, and what is taken of it

        def flush() -> None:
            pieces = [texts[stretches[k][0]][stretches[k][1] + lo : stretches[k][1] + hi] for k, lo, hi, _, _ in group]
            for (k, lo, _, first, last), labels in zip(group, self.labels(pieces), strict=True):
                found[k][first:last] = labels[first - lo : last - lo]
            group.clear()

        size = 0
        for k, (_, a, b) in enumerate(stretches):  # so many characters at a time that the scores stay small
            for first in range(0, b - a, BLOCK):
                last = min(first + BLOCK, b - a)
                lo, hi = max(0, first - LAG), min(b - a, last + LAG)
                group.append((k, lo, hi, first, last))
                size += hi - lo
                if size > 60_000:
                    flush()
                    size = 0
        if group:
            flush()
        for (i, a, _), labels in zip(stretches, found, strict=True):
            text = texts[i]
            for kind, start, end in label_spans(labels):
                start, end = start + a, end + a
                apart = not text[start - 1 : start].isalnum() and not text[end : end + 1].isalnum()
                if apart and valid_added(kind, text[start:end]) and all(end <= p or q <= start for _, p, q in base[i]):
                    out[i].append((kind, start, end))
        return out

    def find(self, df: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
        """keep, base and spans (base and added ones) for each whole text."""
        span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        rank = {k: i for i, k in enumerate(KINDS)}

        def kernel(texts):
            base = [base_spans(t) for t in texts]
            every = [sorted(b + a, key=lambda s: (rank[s[0]], s[1])) for b, a in zip(base, self.added(texts, base), strict=True)]
            return [pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in row] for row in rows], span) for rows in (base, every)]

        return map_text(df, keep, text_col, [("base", SPANS), ("spans", SPANS)], kernel)


CLASS_PAD = 97


def label_spans(labels: np.ndarray) -> list[tuple[str, int, int]]:
    """Spans of labels: 0 outside, 2k + 1 the first character of kind k, 2k + 2 a further one."""
    out, start, kind = [], 0, -1
    for i, t in enumerate([*labels.tolist(), 0]):
        if kind >= 0 and t != 2 * kind + 2:
            out.append((KINDS[kind], start, i))
            kind = -1
        if t and (t % 2 or kind < 0):
            start, kind = i, (t - 1) // 2
    return out


def _labelled(text: str, spans: list[tuple[str, int, int]], at: int) -> tuple[np.ndarray, np.ndarray]:
    """Classes and labels of the window of text that starts at `at`."""
    x, y = np.full(WINDOW, CLASS_PAD, np.int64), np.zeros(WINDOW, np.int64)
    c = classes(text[at : at + WINDOW])
    x[: len(c)] = c
    for kind, start, end in spans:
        k = KINDS.index(kind)
        for i in range(max(start, at), min(end, at + WINDOW)):
            y[i - at] = 2 * k + 1 + (i > start)
    return x, y


def _digits(r: np.random.Generator, n: int) -> str:
    return "".join(map(str, r.integers(0, 10, n)))


def _letters(r: np.random.Generator, n: int) -> str:
    return "".join(map(chr, r.integers(97, 123, n)))


def made_up(kind: str, r: np.random.Generator) -> str:
    """A made-up value of a kind, in a form that the base patterns know."""
    if kind == "email":
        return f"{_letters(r, r.integers(2, 8))}{['', '.', '_'][r.integers(3)]}{_digits(r, r.integers(0, 3))}{_letters(r, r.integers(1, 5))}@{_letters(r, r.integers(3, 8))}{_digits(r, r.integers(0, 2))}.{['com', 'org', 'example.com', 'net'][r.integers(4)]}"
    if kind == "ip":
        return ".".join(map(str, r.integers(0, 256, 4)))
    if kind == "card":
        n = _digits(r, r.integers(12, 16))
        n += next(d for d in "0123456789" if luhn(n + d))
        return n if r.random() < 0.6 else re.sub(r"(.{4})(?=.)", rf"\1{' -'[r.integers(2)]}", n)
    return f"+{_digits(r, r.integers(1, 3))} {['({}) {}-{}', '{}-{}-{}', '{} {} {}'][r.integers(3)].format(_digits(r, 3), _digits(r, 3), _digits(r, 4))}"


def made_up_other(kind: str, r: np.random.Generator) -> tuple[str, str, str]:
    """A made-up value of a kind in a form that the base patterns miss, with what stands right before and after it."""
    if kind == "email":
        a, dot = ["(at)", "[at]"][r.integers(2)], [".", " (dot) ", "[dot]", "."][r.integers(4)]
        gap = " " * int(r.integers(2))
        return "", f"{_letters(r, r.integers(2, 8))}{['', '.', '_'][r.integers(3)]}{_letters(r, r.integers(1, 6))}{gap}{a}{gap}{_letters(r, r.integers(3, 9))}{dot}{['com', 'org', 'net', 'de'][r.integers(4)]}", ""
    if kind == "ip":
        return "", str(ipaddress.IPv6Address(int(r.integers(1, 1 << 62)) << int(r.integers(0, 66)))) if r.random() < 0.3 else ":".join(f"{v:x}" for v in r.integers(1, 1 << 16, 8)), ""
    if kind == "card":
        n = _digits(r, 15)
        n += next(d for d in "0123456789" if luhn(n + d))
        if r.random() < 0.4:
            return "", re.sub(r"(.{4})(?=.)", r"\1.", n), ""
        return (f"{_digits(r, r.integers(4, 17))} ", n, "") if r.random() < 0.5 else ("", n, f" {_digits(r, r.integers(4, 17))}")
    form = ["({}) {}-{}", "0{}/{}{}", "{}-{}-{}", "00{} {} {}", "0{} {} {}", "{}.{}.{}"][r.integers(6)]
    return "", form.format(_digits(r, 3), _digits(r, r.integers(3, 5)), _digits(r, 4)), ""


def made_up_none(r: np.random.Generator) -> str:
    """A made-up number of another kind: a date, time, version, price, count or code."""
    n = lambda a, b: int(r.integers(a, b))
    return [f"{n(1900, 2030)}-{n(1, 13):02}-{n(1, 29):02}", f"{n(1, 29)}.{n(1, 13)}.{n(1900, 2030)}", f"{n(0, 24)}:{n(0, 60):02}", f"{n(0, 20)}.{n(0, 20)}.{n(0, 30)}",
            f"{n(1, 10_000):,}.{n(0, 100):02}", f"{n(1, 100)}%", str(n(1, 10**n(1, 8))), f"{_letters(r, 3)}{_digits(r, 4)}{_letters(r, 2)}", f"{n(0, 1 << 60):016x}", f"@{_letters(r, 6)}"][r.integers(10)]


def _sample(parts: list[str], r: np.random.Generator) -> list[tuple[np.ndarray, np.ndarray]]:
    """Windows of texts with labels: as they are, and with made-up values."""
    pairs = [_labelled(p, base_spans(p), 0) for p in parts]
    for n in range(MADE_UP):
        p = parts[int(r.integers(len(parts)))]
        cut = int(r.integers(0, min(len(p), 50) + 1))
        head, tail, kind = f"{p[:cut]} ", f"{['', '.', ',', ';', ')'][r.integers(5)]} {p[cut:]}", KINDS[n // 5 % 4]
        before, value, after = ("", made_up(kind, r), "") if n % 5 < 2 else made_up_other(kind, r) if n % 5 < 4 else ("", made_up_none(r), "")
        text, at = head + before + value + after + tail, len(head + before)
        known = [("", 0, 0)] if n % 5 == 4 else [(kind, at, at + len(value))]
        spans = [k for k in known if k[0]] + [s for s in base_spans(text) if all(s[2] <= a or b <= s[1] for _, a, b in known)]
        pairs.append(_labelled(text, spans, max(0, at - int(r.integers(0, WINDOW // 2)))))
    return pairs


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_texts: int = MAX_TEXTS, max_windows: int = MAX_WINDOWS) -> Model:
    """Learns from windows of at most max_texts texts that have a digit or @, labelled by the base patterns, and from made-up
    values in them. The windows are chosen from the whole texts, at most max_windows by a hash; only they come to the driver."""
    slim = docs.select(column(id_col).alias("id"), column(text_col).cast("string").alias("text"))
    # At most max_texts ids.
    chosen = F.broadcast(durable(hash_order(slim.where(F.col("text").rlike("[0-9@]")), "id", max_texts, SEED), max_texts))

    def kernel(texts):
        return [pa.array([sorted({t[s : s + WINDOW] for a, b in scored(t or "") for s in range(a, max(a + 1, b - STRIDE), STRIDE)}) for t in texts], pa.list_(pa.string()))]

    windows = map_text(slim.join(chosen, "id", "left_semi"), ["id"], "text", [("parts", "array<string>")], kernel).select(F.explode("parts").alias("part")).distinct()
    parts = [r["part"] for r in windows.orderBy(F.xxhash64("part", F.lit(SEED)), "part").limit(max_windows).collect()]
    r = np.random.default_rng(SEED)
    pairs = _sample(parts or ["a text without numbers, as it is"], r)
    tagger = Tagger(2 * len(KINDS) + 1)
    tagger.fit(np.stack([x for x, _ in pairs]), np.stack([y for _, y in pairs]))
    return Model(tagger)

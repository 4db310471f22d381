"""Text functions as Column expressions: everything stays in the JVM. A profile says what is folded and what is a letter.

Null texts count as empty unless a function says otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .profiles import LATIN, Profile


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text(c: Column | str) -> Column:
    return F.coalesce(_c(c), F.lit(""))


def norm(c: Column | str, p: Profile = LATIN) -> Column:
    """Marks dropped, variants folded in one pass, lower case."""
    return F.translate(F.lower(F.regexp_replace(text(c), f"[{p.marks}]", "")), p.fold_from, p.fold_to)


def clean(c: Column | str, p: Profile = LATIN) -> Column:
    """norm, then each run of other characters than letters as one space, trimmed."""
    return F.trim(F.regexp_replace(norm(c, p), r"[^\p{L}]+", " "))


def tokens(c: Column | str, p: Profile = LATIN) -> Column:
    """Runs of letters and digits of the normalised text. Marks go first, so vowelled and bare texts have the same tokens."""
    return F.regexp_extract_all(norm(c, p), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def surface(c: Column | str) -> Column:
    """Runs of letters, digits and marks as they are written."""
    return F.regexp_extract_all(text(c), F.lit(r"[\p{L}\p{N}\p{M}]+"), F.lit(0))


def words(c: Column | str, p: Profile = LATIN, least: int = 1) -> Column:
    """Words of the text without its marks, as written; words of fewer than `least` letters are left out."""
    return F.regexp_extract_all(F.regexp_replace(text(c), f"[{p.marks}]", ""), F.lit(f"([{p.letters}]{{{least},}})"), F.lit(1))


def _bare(w: Column, p: Profile) -> Column:
    """A word without its proclitics, if three letters stay."""
    if not p.proclitics:
        return w
    front = "".join(f"(?:{'|'.join(g)})?" for g in p.proclitics)
    has = reduce(lambda a, b: a | b, [F.startswith(w, F.lit(x)) for g in p.proclitics for x in g])
    return F.when(has, F.regexp_replace(w, f"^{front}(.{{3,}})$", "$1")).otherwise(w)


def _short(w: Column, p: Profile) -> Column:
    """A word of four letters and more without the final letter that the profile drops."""
    if not p.final:
        return w
    return F.when((F.length(w) >= 4) & F.endswith(w, F.lit(p.final)), F.substring(w, F.lit(1), F.length(w) - 1)).otherwise(w)


def _common(w: Column, p: Profile) -> Column:
    for a, b in p.same.items():
        w = F.when(w == a, F.lit(b)).otherwise(w)
    return w


def stem(w: Column, p: Profile = LATIN) -> Column:
    """A normalised word without proclitics (if three letters stay) and without the final letter that the profile drops."""
    return _common(_short(_bare(w, p), p), p)


def stems(c: Column | str, p: Profile = LATIN) -> Column:
    """The stems of a text's words. Each step goes over all words by itself, as an expression that another one holds several
    times is computed as often."""
    out = F.regexp_extract_all(norm(c, p), F.lit(r"\p{L}+"), F.lit(0))
    for step, used in ((_bare, p.proclitics), (_short, p.final), (_common, p.same)):
        if used:
            out = _each(out, step, p)
    return out


def _each(words: Column, step, p: Profile) -> Column:
    return F.transform(words, lambda w: step(w, p))


def content(toks: Column, stop: list[str] | frozenset[str], least: int = 2) -> Column:
    """Tokens of at least `least` characters that aren't in the stop list."""
    stop_array = F.array(*[F.lit(s) for s in sorted(stop)])
    return F.filter(toks, lambda w: (F.length(w) >= least) & ~F.array_contains(stop_array, w))


def let(value: Column, body) -> Column:
    """body(value) with value computed once: an expression inside a lambda would be computed for each element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def grams(toks: Column, k: int) -> Column:
    """All runs of k tokens, joined by a space; none of fewer tokens."""
    return let(toks, lambda t: _grams(t, k))


def _grams(toks: Column, k: int) -> Column:
    return F.when(F.size(toks) >= k, F.transform(F.sequence(F.lit(1), F.size(toks) - k + 1), lambda i: F.array_join(F.slice(toks, i, k), " "))).otherwise(F.array().cast("array<string>"))


def shingles(toks: Column, k: int = 3) -> Column:
    """The set of crc32 sums of the runs of k tokens."""
    return F.array_distinct(F.transform(grams(toks, k), lambda g: F.crc32(g.cast("binary"))))


def root_token(c: Column | str) -> Column:
    """A root without separators; `#` (a weak radical) as tatweel."""
    return F.replace(F.replace(_c(c), F.lit("."), F.lit("")), F.lit("#"), F.lit("ـ"))


def root_variants(c: Column | str, weak: str = "اوي", mark: str = "ـ") -> Column:
    """The root, and for each weak radical the root with the mark in its place; sorted."""
    r = F.replace(F.replace(_c(c), F.lit("."), F.lit("")), F.lit(" "), F.lit(""))
    change = F.transform(F.sequence(F.lit(1), F.greatest(F.length(r), F.lit(1))), lambda i: F.when(F.lit(weak).contains(F.substring(r, i, F.lit(1))) & (F.substring(r, i, F.lit(1)) != ""), F.concat(F.substring(r, F.lit(1), i - 1), F.lit(mark), F.substring(r, i + 1, F.length(r)))))
    return F.array_sort(F.array_distinct(F.array_append(F.array_compact(change), r)))


def name_norm(c: Column | str, same: list[tuple[str, str]], p: Profile = LATIN) -> Column:
    """clean, then whole words replaced by the word that stands for them."""
    t = F.concat(F.lit(" "), F.replace(clean(c, p), F.lit(" "), F.lit("  ")), F.lit(" "))
    for a, b in same:
        t = F.replace(t, F.lit(f" {a} "), F.lit(f" {b} "))
    return F.trim(F.regexp_replace(t, " +", " "))


#: Marks of page turns, milestones and quotations in marked-up texts.
MARKUP = r"Page(?:End)?V\d+P\d+|ms\d+|@Q[BE]@|[#|*~]+"


def clean_markup(c: Column | str, pattern: str = MARKUP) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(text(c), pattern, " "), r"\s+", " "))


def flat(hemistichs: Column | str, *texts: Column | str) -> Column:
    """A record's text: its half lines with ` / ` between, or the first of the other columns that isn't null."""
    return F.coalesce(F.when(F.size(_c(hemistichs)) > 0, F.array_join(_c(hemistichs), " / ")), *[_c(t) for t in texts])


def flat_json(c: Column | str, without: tuple[str, ...] = ("lang", "edition")) -> Column:
    """The text values of a JSON object, down to two levels, with a space between; keys of `without` are left out. Null stays null."""
    top = F.from_json(_c(c), "map<string,string>")
    kept = F.map_filter(top, lambda k, _: ~k.isin(*without))
    inner = F.transform(F.map_values(kept), lambda v: F.coalesce(F.array_join(F.map_values(F.map_filter(F.from_json(v, "map<string,string>"), lambda k, _: ~k.isin(*without))), " "), v))
    return F.when(_c(c).isNotNull(), F.array_join(F.filter(inner, lambda v: v != ""), " "))


def split_marker(c: Column | str, marker: str) -> tuple[Column, Column, Column]:
    """What stands before the first marker, after it, and which way the text was split (marker or none)."""
    t = text(c)
    at = F.instr(t, marker)
    found = at > 0
    head = F.when(found, F.trim(F.substring(t, F.lit(1), at - 1))).otherwise(F.lit(""))
    return head, F.when(found, F.trim(F.substring(t, at + len(marker), F.length(t)))).otherwise(F.trim(t)), F.when(found, F.lit("marker")).otherwise(F.lit("none"))


def first_match(c: Column | str, rules: list[tuple[str, str]], otherwise: str | None) -> Column:
    """The label of the first rule (label, pattern) that matches; the rules' order is their rank."""
    out = F.lit(otherwise)
    for label, pattern in reversed(rules):
        out = F.when(_c(c).rlike(pattern), F.lit(label)).otherwise(out)
    return out


def cues(c: Column | str, rules: list[tuple[str, str]], reference: str | None = None) -> Column:
    """The labels of the rules (label, pattern) that occur, by the place of their first occurrence, joined by commas.

    A text of none of them that `reference` matches (it says where a thing is) is a cross_reference.
    """
    found = F.array(*[F.struct(F.regexp_instr(_c(c), F.lit(pattern)).alias("at"), F.lit(label).alias("label")) for label, pattern in rules])
    out = F.array_join(F.transform(F.array_sort(F.filter(found, lambda s: s["at"] > 0)), lambda s: s["label"]), ",")
    return out if reference is None else F.when((out == "") & _c(c).rlike(reference), "cross_reference").otherwise(out)


def verdict_class(c: Column | str, negative: list[tuple[str, str]], positive: list[tuple[str, str]], reserve: str, support: str, disputed: str, chain: str | None = None, chain_fair: str = "fair") -> Column:
    """One class of a verdict that may say several things.

    Support by other routes comes first, then a disputed narrator, then a contradiction (disputed); a reservation after
    a positive word counts as weak. chain: a pattern for a grade of the chain in hand that is no more than fair; it
    overrides the positive class that later words of other routes may give.
    """
    n = _c(c)
    neg, pos = first_match(n, negative, None), first_match(n, positive, None)
    if chain is not None:
        pos = F.when(pos.isNotNull() & n.rlike(chain), F.lit(chain_fair)).otherwise(pos)
    neg = F.when(neg.isNull() & pos.isNotNull() & n.rlike(reserve), F.lit("weak")).otherwise(neg)
    return F.when(n.rlike(support), "sound_by_support").when(n.rlike(disputed), "disputed_narrator").when(neg.isNotNull() & pos.isNotNull(), "disputed").otherwise(F.coalesce(neg, pos, F.lit("unclassified")))


def labelled(c: Column | str, labels: dict[str, str], otherwise: str | None = None) -> Column:
    """The label of a value; `otherwise` for values without one."""
    return F.coalesce(F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])[_c(c)], F.lit(otherwise))


def extracted(c: Column | str, pattern: str, group: int = 1, most: int | None = None) -> Column:
    """What a group of the pattern holds at each of its matches, or at the first `most` of them."""
    found = F.regexp_extract_all(text(c), F.lit(pattern), F.lit(group))
    return found if most is None else F.slice(found, 1, most)


def before_cue(c: Column | str, cue: str) -> Column:
    """The text before the first match of cue, or all of it."""
    at = F.regexp_instr(text(c), F.lit(cue))
    return F.when(at > 0, F.substring(text(c), F.lit(1), at - 1)).otherwise(text(c))


def named(c: Column | str, names: list[tuple[str, str, list[str]]], chain_cue: str) -> Column:
    """struct(names, collections): the collections that a text names (name, pattern, their keys), in the rules' order.

    Where it speaks of a chain, only what stands before that counts, unless nothing does.
    """
    kind = "array<string>"

    def scan(t: Column) -> Column:
        hit = [F.when(t.rlike(pattern), F.struct(F.lit(name).alias("name"), F.array(*[F.lit(k) for k in keys]).alias("keys"))) for name, pattern, keys in names]
        return F.array_compact(F.array(*hit))

    first = scan(before_cue(c, chain_cue))
    found = F.when(F.size(first) > 0, first).otherwise(scan(text(c)))
    return let(found, lambda f: F.struct(F.transform(f, lambda x: x["name"]).cast(kind).alias("names"), F.array_distinct(F.flatten(F.transform(f, lambda x: x["keys"]))).cast(kind).alias("collections")))


def split_tail(c: Column | str, quotes: str, cue: str) -> Column:
    """struct(quote, tail): a text cut at the first cue after its last closing quote (one of `quotes`); if none follows there,
    at the first cue of all; without any, the tail is empty. The cue's match begins the tail."""
    t = text(c)
    last = F.regexp_extract(t, f"(?s)^.*[{quotes}]", 0)
    after, whole = F.regexp_instr(F.substring(t, F.length(last) + 1, F.length(t)), F.lit(cue)), F.regexp_instr(t, F.lit(cue))
    at = F.when(after > 0, F.length(last) + after).otherwise(whole)
    return let(at, lambda a: F.struct(F.trim(F.when(a > 0, F.substring(t, F.lit(1), a - 1)).otherwise(t)).alias("quote"), F.trim(F.when(a > 0, F.substring(t, a, F.length(t))).otherwise("")).alias("tail")))


def split_chain(c: Column | str, marker: str, mention: str, word: str, within: int = 12) -> Column:
    """struct(isnad, matn, how): a text cut at the first marker; else after the first mention, with `word` too if that follows
    within so many characters; else it is all matn. Marker is a literal, the others are patterns."""
    t = text(c)
    at = F.instr(t, marker)
    long = f"(?s)^.*?(?:{mention})(?:.{{0,{within}}}?(?:{word}))?"
    head = F.regexp_extract(t, long, 0)
    cut = F.when(at > 0, at - 1).when(head != "", F.length(head))
    how = F.when(at > 0, "marker").when(head != "", "prophet_mention").otherwise("none")
    rest = F.when(at > 0, F.substring(t, at + len(marker), F.length(t))).when(head != "", F.substring(t, F.length(head) + 1, F.length(t))).otherwise(t)
    return F.struct(F.trim(F.coalesce(F.substring(t, F.lit(1), cut), F.lit(""))).alias("isnad"), F.trim(rest).alias("matn"), how.alias("how"))


def items(c: Column | str, opener: str, closer: str) -> Column:
    """The parts of a text that run from each opener to the next closer (or the end), without what stands between them."""
    return F.transform(F.regexp_extract_all(text(c), F.lit(f"(?s){opener}.*?(?={closer}|\\z)"), F.lit(0)), lambda x: F.trim(x))


def matches(c: Column, pattern: str) -> Column:
    """array<struct<start,end,text>> of the leftmost matches that don't overlap; places count from 0."""
    found = F.regexp_extract_all(c, F.lit(pattern), F.lit(0))
    gaps = F.split(c, pattern)

    def step(acc: Column, i: Column) -> Column:
        m = F.get(found, i)
        start = acc["at"] + F.length(F.get(gaps, i))
        return F.struct((start + F.length(m)).alias("at"), F.array_append(acc["out"], F.struct(start.alias("start"), (start + F.length(m)).alias("end"), m.alias("text"))).alias("out"))

    none = F.array().cast("array<struct<start:int,end:int,text:string>>")
    first = F.struct(F.lit(0).alias("at"), none.alias("out"))
    return F.when(F.size(found) > 0, F.aggregate(F.sequence(F.lit(0), F.size(found) - 1), first, step, lambda acc: acc["out"])).otherwise(none)


def same_names(a: Column, b: Column) -> Column:
    """Whether two name sets share a name; null if either is empty."""
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.arrays_overlap(a, b))


def kwic(toks: Column, word: Column | str, before: int = 12, after: int = 14) -> Column:
    """The words around the first one that contains `word`."""
    w = F.lit(word) if isinstance(word, str) else word

    def body(t: Column) -> Column:
        at = F.get(F.filter(F.transform(t, lambda x, i: F.when(F.contains(x, w), i)), lambda i: i.isNotNull()), F.lit(0))
        return let(at, lambda a: F.when(a.isNotNull(), F.array_join(F.slice(t, F.greatest(a - before, F.lit(0)) + 1, a + after + 1 - F.greatest(a - before, F.lit(0))), " ")))

    return let(toks, body)


def page_segments(c: Column | str, mark: str, number: str) -> Column:
    """(mark, text) for the text before the first page mark (null), and after each one: its number."""
    parts = F.split(text(c), mark)
    numbers = F.concat(F.array(F.lit(None).cast("string")), F.regexp_extract_all(text(c), F.lit(number), F.lit(1)))
    return F.arrays_zip(numbers.alias("mark"), parts.alias("text"))


#: A page mark: it ends page P of volume V.
PAGE_MARK = r"Page(?:End)?V(\d+)P(\d+)"


def exact_pages(c: Column | str, vol: Column, page_before: Column) -> Column:
    """array<struct<vol,page,text>>: a text cut at its page marks. It starts on the page after page_before; after a mark of
    page P comes page P + 1 of the mark's volume."""
    parts = F.split(text(c), PAGE_MARK)
    vols, pages = (F.transform(F.regexp_extract_all(text(c), F.lit(PAGE_MARK), F.lit(g)), lambda x: x.cast("int")) for g in (1, 2))
    first = F.struct(vol.cast("int").alias("vol"), (page_before + 1).cast("int").alias("page"))
    later = F.transform(F.arrays_zip(vols.alias("v"), pages.alias("p")), lambda z: F.struct(z["v"].alias("vol"), (z["p"] + 1).alias("page")))
    return F.zip_with(F.concat(F.array(first), later), parts, lambda a, t: F.struct(a["vol"].alias("vol"), a["page"].alias("page"), t.alias("text")))


def page_name(vol: Column, page: Column) -> Column:
    return F.concat_ws(":", vol.cast("string"), page.cast("string"))


def locator(parts: dict[str, Column]) -> Column:
    """`name=value` of the values that aren't null."""
    return F.concat_ws(" ", *[F.when(v.isNotNull(), F.concat(F.lit(f"{k}="), v.cast("string"))) for k, v in parts.items()])


def ocr_quality(toks: Column, pattern: str = r"^\p{L}{2,15}$", least: int = 8) -> tuple[Column, Column]:
    """(clean tokens, tokens); both null for fewer than `least` tokens. The score is 100 times their ratio."""
    enough = F.size(toks) >= least
    return F.when(enough, F.size(F.filter(toks, lambda w: w.rlike(pattern)))), F.when(enough, F.size(toks))


def skeleton(c: Column | str, p: Profile = LATIN, article: str = r"\b(?:al|the|el|la|le|der|die|das) ", vowels: str = "[aeiouy ]") -> Column:
    """The consonants of a text without its articles."""
    return F.regexp_replace(F.regexp_replace(clean(c, p), article, ""), vowels, "")


def year_of(c: Column | str, pattern: str, default: Column | None = None) -> Column:
    """The number that the pattern's first group finds, or default."""
    y = F.regexp_extract(text(c), pattern, 1)
    return F.coalesce(F.when(y != "", y.cast("int")), *([default] if default is not None else []))


def digits(c: Column | str) -> Column:
    """Arabic-Indic and Persian digits as ASCII ones."""
    return F.translate(_c(c), "٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹", "01234567890123456789")


def compact(c: Column | str) -> tuple[Column, Column]:
    """A text as an integer where it is digits only, and itself."""
    return F.when(_c(c).rlike(r"^[0-9]{1,18}$"), _c(c).cast("long")), _c(c)


def decimal(c: Column | str) -> Column:
    """A text as a number, or null; with a comma or a point."""
    return F.replace(F.trim(_c(c)), F.lit(","), F.lit(".")).try_cast("double")


def entry_id(c: Column | str, size: int = 100_000) -> Column:
    """A short number of a text: its crc32 sum, modulo size."""
    return F.crc32(text(c).cast("binary")) % size


def json_get(c: Column | str, path: str, default: str = "") -> Column:
    """A nested value of a JSON text (keys between dots), or default."""
    return F.coalesce(F.get_json_object(_c(c), f"$.{path}"), F.lit(default))


def json_peek(c: Column | str, key: str = "id") -> Column:
    """The value of a key of a JSON line, by a pattern alone: cheaper than parsing, for filters before it. Null if it isn't there."""
    value = F.regexp_extract(text(c), f'"{key}"\\s*:\\s*"?([^",}}]*)', 1)
    return F.when(value != "", F.trim(value))


def excerpt(toks: Column, start: Column, stop: Column, around: int) -> Column:
    """The tokens from start to stop and `around` on either side, with an ellipsis where more stands."""

    def body(t: Column) -> Column:
        lo, hi = F.greatest(start - around, F.lit(0)), F.least(stop + around + 1, F.size(t))
        return F.concat(F.when(lo > 0, "… ").otherwise(""), F.array_join(F.slice(t, lo + 1, hi - lo), " "), F.when(hi < F.size(t), " …").otherwise(""))

    return let(toks, body)


def near_cues(toks: Column, start: Column, stop: Column, rules: dict[str, str], before: int = 15, after: int = 50, most: int = 4) -> Column:
    """For each class the distinct matches of its pattern in the words near a match, sorted, at most `most`:
    array<struct<class, words>>. Patterns are looked for in the words with a space between them and around them."""

    def body(t: Column) -> Column:
        lo = F.greatest(start - before, F.lit(0))
        part = F.concat(F.lit(" "), F.array_join(F.slice(t, lo + 1, stop + after + 1 - lo), " "), F.lit(" "))

        def hits(pattern: str) -> Column:
            return F.slice(F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(part, F.lit(pattern), F.lit(0)), lambda x: F.trim(x)))), 1, most)

        found = [F.struct(F.lit(c).alias("class"), hits(x).alias("words")) for c, x in rules.items()]
        return F.filter(F.array(*found), lambda s: F.size(s["words"]) > 0)

    return let(toks, body)


def cut_name(c: Column | str, cut: str, same: dict[str, str], p: Profile = LATIN) -> Column:
    """A name up to the first match of `cut` (honorifics, verbs of speech), normalised, special forms replaced whole."""
    head = F.get(F.split(text(c), cut, 2), F.lit(0))
    n = clean(head, p)
    return F.coalesce(F.create_map(*[F.lit(x) for kv in same.items() for x in kv])[n], n) if same else n


def plain(c: Column | str, p: Profile = LATIN) -> Column:
    """Letters only, for comparisons."""
    return F.replace(clean(c, p), F.lit(" "), F.lit(""))

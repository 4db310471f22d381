"""A declarative acceptance test: a table of cases, each a check with conditions on the numbers it returns."""

from __future__ import annotations

import operator
import re
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEVELS = ("must", "goal")
_CONDITION = re.compile(r"\s*(\w+)\s*(>=|<=|==|!=|>|<|=)\s*(-?\d+(?:\.\d+)?)\s*(s|%)?\s*\Z")
_OPS = {">=": operator.ge, "<=": operator.le, "==": operator.eq, "=": operator.eq, "!=": operator.ne, ">": operator.gt, "<": operator.lt}


@dataclass(frozen=True)
class Case:
    id: str
    level: str
    check: str
    input: str = ""
    where: str = ""
    expect: str = ""
    why: str = ""


def parse_table(markdown: str) -> list[Case]:
    """The cases of a table with a column for each field of Case; rows of other tables are skipped. Ids must differ."""
    cases: list[Case] = []
    columns: list[str] = []
    for line in markdown.splitlines():
        cells = [c.strip() for c in line.strip().strip("|").split("|")] if line.strip().startswith("|") else []
        if not cells:
            columns = []
        elif "id" in cells and "check" in cells:
            columns = cells
        elif columns and not set("".join(cells)) <= set("-: "):
            row = dict(zip(columns, cells, strict=False))
            case = Case(**{k: row[k] for k in Case.__dataclass_fields__ if k in row})
            if case.level not in LEVELS:
                raise ValueError(f"{case.id}: unknown level {case.level!r}")
            if any(c.id == case.id for c in cases):
                raise ValueError(f"{case.id} stands there twice")
            cases.append(case)
    return cases


def parse_conditions(text: str) -> list[tuple[str, Callable, object]]:
    """Conditions between commas: `name op number`, with a unit of s or % (a share: divided by 100); `fact:words`, which holds if
    a value of that fact has these words, in any case; or a bare name, which holds if its number isn't 0."""
    out = []
    for part in filter(None, (p.strip() for p in text.split(","))):
        m = _CONDITION.match(part)
        if m:
            out.append((m[1], _OPS[m[2]], float(m[3]) / (100 if m[4] == "%" else 1)))
        elif re.fullmatch(r"\w+", part):
            out.append((part, operator.ne, 0))
        elif re.fullmatch(r"\w+:.+", part):
            name, words = part.split(":", 1)
            out.append((name, lambda values, w: any(w in v.lower() for v in values), words.strip().lower()))
        else:
            raise ValueError(f"not a condition: {part!r}")
    return out


def run(cases: list[Case], checks: dict[str, Callable[[Case], dict]]) -> list[dict]:
    """One result for each case: passed, what was found (numbers, and lists of texts as facts), and why not. A case that breaks
    never hides the others; a kind of check that isn't known is an error before any case runs."""
    unknown = sorted({c.check for c in cases if c.check not in checks})
    if unknown:
        raise ValueError(f"unknown checks: {', '.join(unknown)}")
    out = []
    for case in cases:
        result = {"id": case.id, "level": case.level, "passed": False, "numbers": {}, "why": ""}
        try:
            conditions = parse_conditions(case.expect)
            numbers = checks[case.check](case)
            failed = [name for name, op, want in conditions if name not in numbers or not op(numbers[name], want)]
            result |= {"passed": not failed, "numbers": numbers, "why": ", ".join(failed)}
        except Exception as e:  # noqa: BLE001  a broken case is a failed case
            result["why"] = f"{type(e).__name__}: {e}"
        out.append(result)
    return out


@dataclass
class Library:
    """What the checks ask: functions that give DataFrames, so that each engine is tested through its own tables.

    authenticate: texts -> (q, uid, collection, critic, layer, grade), q being a text's place in the list; search: phrase and
    folders (none: all) -> (folder, work, uid); verse and concept: a key -> (work, death, uid) in the order of the lookup;
    cite: id and phrase -> (kind, loc); story: id -> (heading, story, passage, reading); caliphs: (caliph); entries: (type);
    offences: (check, key); metrics: name -> number.
    """

    authenticate: Callable[[list[str]], DataFrame]
    search: Callable[[str, list[str]], DataFrame]
    verse: Callable[[str], DataFrame]
    concept: Callable[[str], DataFrame]
    cite: Callable[[str, str], DataFrame]
    story: Callable[[str], DataFrame]
    caliphs: DataFrame
    entries: DataFrame
    offences: DataFrame
    metrics: dict[str, Callable[[], float]]


def checks(library: Library, cases: list[Case]) -> dict[str, Callable[[Case], dict]]:
    """The twelve kinds of check. The texts of all cases that match loosely go through one scan, which is timed."""
    texts: list[str] = []
    for c in cases:
        if c.check == "authenticate" or (c.check == "crash" and c.where == "authenticate"):
            texts.append(c.input)
        elif c.check == "same":
            texts += [x.strip() for x in c.input.split("//")]
    texts = list(dict.fromkeys(texts))
    timing: dict[str, float] = {}
    hits: dict[str, list] = {t: [] for t in texts}
    if texts:
        began = time.monotonic()
        for r in library.authenticate(texts).collect():  # the matches of a stated set of texts
            hits[texts[r["q"]]].append(r)
        timing["authenticate_all"] = time.monotonic() - began
        timing["authenticate_per_saying"] = timing["authenticate_all"] / len(texts)

    def authenticate(c: Case) -> dict:
        rows = hits[c.input]
        found = {k: sorted({r[k] for r in rows if r[k] is not None}) for k in ("collection", "critic", "grade")}
        modern = [r for r in rows if r["layer"] == "modern"]
        return {
            "hits": len({r["uid"] for r in rows}), "collections": len(found["collection"]), "critics": len(found["critic"]), "in": found["collection"], "critic": found["critic"],
            "grade": sorted({f"{r['critic']}:{r['grade']}" for r in rows if r["grade"] is not None and r["layer"] == "classical"}), "not_in_layer": int(not rows),
            "modern_apart": int(bool(modern) and not {r["critic"] for r in modern} & {r["critic"] for r in rows if r["layer"] == "classical"}), "cites": int(all(r["uid"] is not None for r in rows)),
        }

    def same(c: Case) -> dict:
        a, b = ({r["uid"] for r in hits[x.strip()]} for x in c.input.split("//"))
        return {"same": int(a == b and bool(a)), "first": len(a), "second": len(b)}

    def search(c: Case) -> dict:
        folders = [x for x in c.where.split(",") if x and x != "all"]
        began = time.monotonic()
        rows = library.search(c.input, folders).groupBy("folder").agg(F.countDistinct("uid").alias("n"), F.countDistinct("work").alias("w")).collect()
        if not folders:
            timing["search_whole_corpus"] = time.monotonic() - began
        seen = {r["folder"]: r["n"] for r in rows}
        return {"records": sum(seen.values()), "works": sum(r["w"] for r in rows), "folders_with_hits": sum(seen.get(f, 0) > 0 for f in folders), "each_folder": int(all(seen.get(f, 0) > 0 for f in folders)), "folder": sorted(seen)}

    def lookup(f: Callable[[str], DataFrame]) -> Callable[[Case], dict]:
        def check(c: Case) -> dict:
            rows = f(c.input).collect()  # some passages of each work
            years = [r["death"] for r in rows if r["death"] is not None]
            return {"passages": len(rows), "works": len({r["work"] for r in rows}), "oldest_first": int(years == sorted(years))}

        return check

    def caliph(c: Case) -> dict:
        return {"hadith": library.caliphs.where(F.col("caliph") == c.input).count()}

    def cite(c: Case) -> dict:
        rows = library.cite(c.input, c.where).limit(2).collect()
        ok = bool(rows) and rows[0]["kind"] not in ("absent", "missing")
        if not ok:
            raise LookupError(f"{c.input} isn't there")
        return {"resolved": 1, "kind": [rows[0]["kind"]], "loc": [rows[0]["loc"]]}

    def story(c: Case) -> dict:
        rows = library.story(c.input).collect()
        count = lambda k: len({r[k] for r in rows if r[k] is not None})
        return {"heading": int(count("heading") > 0), "story": int(count("story") > 0), "passages": count("passage"), "readings": count("reading"), "says": [str(r["heading"]) for r in rows]}

    def ledger(c: Case) -> dict:
        if c.input == "validator":
            return {"problems": library.offences.count(), "entries": library.entries.count()}
        return {"entries": library.entries.where(F.col("type") == c.input.split(":", 1)[1]).count()}

    def metric(c: Case) -> dict:
        return {"value": library.metrics[c.input]()}

    def timed(c: Case) -> dict:
        return {"seconds": timing[c.input]}

    def crash(c: Case) -> dict:
        if c.where == "authenticate":
            return {"ran": int(c.input in hits)}
        library.search(c.input, [x for x in c.where.split(",") if x]).count()
        return {"ran": 1}

    return {"authenticate": authenticate, "same": same, "search": search, "verse": lookup(library.verse), "concept": lookup(library.concept), "caliph": caliph, "cite": cite, "story": story, "sijill": ledger, "metric": metric, "time": timed, "crash": crash}


def verdict(results: list[dict]) -> bool:
    """Whether every `must` case passed."""
    return all(r["passed"] for r in results if r["level"] == "must")

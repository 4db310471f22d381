"""Record readers: JSON lines, tab-separated tables, marked-up texts, leaves, whole folders. Schemas are given, never inferred."""

from __future__ import annotations

import io
import zipfile
from xml.etree import ElementTree

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: The superset of corpus records; a reader leaves what a record lacks null.
UNIT = (
    "id string, work string, version string, kind string, level int, vol int, page_before int, leaf int, text_raw string, text string, "
    "headings array<string>, hemistichs array<string>, number string, isnad string, matn string, unit_type string, part string, seq int, provenance string"
)
CORRUPT = "corrupt_record"


def json_lines(spark: SparkSession, path: str | list[str], schema: str = UNIT, glob: str = "*.jsonl*", recursive: bool = True) -> DataFrame:
    """Records of JSON-lines files (gzip by suffix) with the file's path; odd lines are kept in corrupt_record, not dropped."""
    reader = spark.read.schema(f"{schema}, {CORRUPT} string").option("columnNameOfCorruptRecord", CORRUPT).option("mode", "PERMISSIVE")
    df = reader.option("pathGlobFilter", glob).option("recursiveFileLookup", str(recursive).lower()).json(path)
    return df.withColumn("path", F.col("_metadata.file_path"))


def prefiltered_json_lines(spark: SparkSession, path: str, pattern: str, schema: str = UNIT) -> DataFrame:
    """Records of those lines only that match a pattern of the raw text, tested before decoding.

    The pattern must match every line whose record can match (escaped lines, with a backslash and u, always pass).
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    return lines.where(F.col("value").rlike(pattern) | F.contains("value", F.lit("\\u"))).select(F.from_json("value", schema).alias("r")).select("r.*")


def tab_separated(spark: SparkSession, path: str, schema: str, quoted: bool = False) -> DataFrame:
    """A headered table; without quoting unless asked. A missing file is an empty table."""
    reader = spark.read.schema(schema).option("sep", "\t").option("header", "true").option("quote", '"' if quoted else "")
    try:
        return reader.csv(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], schema)
        raise


def marked_up(lines: DataFrame, key: str = "path", order: str = "line", text: str = "value") -> DataFrame:
    """Paragraphs and headings of marked-up lines: `# ` opens one, `~~` goes on, `### |` is a heading with its level.

    A page mark holds from the line after it, so a paragraph has the page before it; marks are dropped from its text.
    """
    w = Window.partitionBy(key).orderBy(order)
    t = F.col(text)
    blank, more, heading = F.trim(t) == "", t.startswith("~~"), t.rlike(r"^### \|+")
    marks = F.regexp_extract_all(t, F.lit(r"PageV\d+P(\d+)"), F.lit(1))
    df = lines.withColumn("page_here", F.when(F.size(marks) > 0, F.element_at(marks, -1).cast("int")))
    df = df.withColumn("page_before", F.last("page_here", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    df = df.withColumn("unit", F.sum(F.when(blank | more, 0).otherwise(1)).over(w)).where(~blank)
    body = F.regexp_replace(F.regexp_replace(t, r"^(?:### \|+ ?|# |~~)", ""), r"Page(?:End)?V\d+P\d+|ms\d+", " ")
    df = df.withColumn("body", body).withColumn("level", F.when(heading, F.length(F.regexp_extract(t, r"^### (\|+)", 1))))
    joined = F.transform(F.sort_array(F.collect_list(F.struct(order, "body"))), lambda x: x["body"])
    out = df.groupBy(key, "unit").agg(F.array_join(joined, " ").alias("raw"), F.max("level").alias("level"), F.min_by("page_before", order).alias("page_before"))
    return out.select(key, "unit", F.when(F.col("level").isNull(), "para").otherwise("heading").alias("kind"), "level", "page_before", F.trim(F.regexp_replace("raw", r"\s+", " ")).alias("text"))


def leaves(texts: DataFrame, key: str, text: str, spans: str) -> DataFrame:
    """One row for each leaf: a text sliced by an array of (start, end) positions."""
    return texts.select(key, text, F.posexplode(spans).alias("leaf", "s")).select(key, "leaf", F.col(text).substr(F.col("s.start") + 1, F.col("s.end") - F.col("s.start")).alias("text"))


def indexed_leaves(texts: DataFrame, key: str, text: str, index: str, printed: str) -> DataFrame:
    """One row for each leaf of an OCR text: index is a JSON array of [start, end) positions, printed a JSON object of the leaves'
    printed pages (those without one have null)."""
    spans = F.transform(F.from_json(index, "array<array<int>>"), lambda x: F.struct(F.get(x, F.lit(0)).alias("start"), F.get(x, F.lit(1)).alias("end")))
    pages = texts.select(F.col(key).alias("k_"), F.from_json(printed, "map<string,string>").alias("m_"))
    out = leaves(texts.withColumn("spans_", spans), key, text, "spans_")
    return out.join(pages, F.col(key) == F.col("k_")).select(key, "leaf", F.col("m_")[F.col("leaf").cast("string")].alias("printed_page"), "text")


def couplets(verses: DataFrame, poem: str, order: str, position: str, text: str) -> DataFrame:
    """Half lines as units: a `right` one takes the `left` one right after it (bayt), a `center1` one the `center2` one (band),
    paragraphs stand by themselves and comments go; any other half line stays single, with a warning."""
    w = Window.partitionBy(poem).orderBy(order)
    v = verses.withColumns({"next_": F.lead(position).over(w), "next_text": F.lead(text).over(w), "prev_": F.coalesce(F.lag(position).over(w), F.lit(""))}).where(F.coalesce(position, F.lit("")) != "comment")
    opens = lambda a, b: (F.col(position) == a) & (F.coalesce("next_", F.lit("")) == b)
    taken = ((F.col(position) == "left") & (F.col("prev_") == "right")) | ((F.col(position) == "center2") & (F.col("prev_") == "center1"))
    v = v.where(~F.coalesce(taken, F.lit(False)))
    kind = F.when(opens("right", "left"), "bayt").when(opens("center1", "center2"), "band").when(F.col(position) == "paragraph", "paragraph").otherwise("single_line")
    pair = F.when(kind.isin("bayt", "band"), F.array(text, "next_text")).otherwise(F.array(text))
    return v.select(poem, order, kind.alias("unit_type"), pair.alias("hemistichs"), (kind == "single_line").alias("warning"))


def tree_walk(nodes: DataFrame, key: str, parent: str, order: str, title: str, depth: int = 8) -> DataFrame:
    """(key, path, place) of a catalogue's nodes, depth first: path holds the titles from the root, place sorts the nodes as a
    walk meets them. Nodes below `depth` levels are an error, not a cut."""
    mine = F.struct(F.col(order).alias("o"), F.col(key).cast("string").alias("k"))
    level = nodes.where(F.col(parent).isNull()).select(F.col(key).alias("id"), F.array(title).alias("path"), F.array(mine).alias("place"))
    out = level
    for k in range(depth + 1):  # one join a level; catalogues are small
        up = level.withColumnsRenamed({"id": "p_id", "path": "p_path", "place": "p_place"})
        level = nodes.join(up, F.col(parent) == F.col("p_id")).select(F.col(key).alias("id"), F.array_append("p_path", F.col(title)).alias("path"), F.array_append("p_place", mine).alias("place"))
        if k == depth:
            deep = level.select(F.raise_error(F.concat(F.lit("too deep: "), F.col("id").cast("string"))).cast(out.schema["id"].dataType).alias("id"), "path", "place")
            return out.unionByName(deep).withColumnRenamed("id", key)
        out = out.unionByName(level)
    return out.withColumnRenamed("id", key)


def word_paragraphs(files: DataFrame) -> DataFrame:
    """(path, line, text) of the paragraphs of Word files (path, content) that aren't blank."""

    @F.pandas_udf("array<string>")
    def paragraphs(contents: pd.Series) -> pd.Series:
        name = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"

        def read(content: bytes) -> list[str]:
            root = ElementTree.fromstring(zipfile.ZipFile(io.BytesIO(content)).read("word/document.xml"))
            return ["".join(t.text or "" for t in p.iter(f"{name}t")) for p in root.iter(f"{name}p")]

        return contents.map(read)

    return files.select("path", F.posexplode(paragraphs("content")).alias("line", "text")).where(F.trim("text") != "")


def folder_records(spark: SparkSession, root: str, folders: list[str] = (), names: str = "", schema: str = UNIT) -> DataFrame:
    """Records of the JSON-lines files under root, in all depths: of some folders only, and of files whose names have one of the
    parts (between commas, in any case). Other folders aren't listed."""
    df = json_lines(spark, [f"{root}/{f}" for f in folders] if folders else root, schema)
    parts = [p.strip().lower() for p in names.split(",") if p.strip()]
    if parts:
        file = F.lower(F.substring_index("path", "/", -1))
        wanted = F.contains(file, F.lit(parts[0]))
        for p in parts[1:]:
            wanted = wanted | F.contains(file, F.lit(p))
        df = df.where(wanted)
    return df


def verified(files: DataFrame, expected: DataFrame) -> DataFrame:
    """Files (path, content) whose SHA-256 is the expected one (path, sha256); fails on another."""
    joined = files.select("path", "content", F.sha2("content", 256).alias("got")).join(expected, "path")
    ok = F.when(F.col("got") == F.col("sha256"), F.col("path")).otherwise(F.raise_error(F.concat(F.lit("checksum of "), "path")))
    return joined.select(ok.alias("path"), "content")


def body_and_notes(df: DataFrame, text: str, separator: str = "\n__________") -> DataFrame:
    """df with the text before the separator and the notes after it (null if there is none)."""
    at = F.instr(text, separator)
    return df.withColumns({"body": F.when(at > 0, F.col(text).substr(F.lit(1), at - 1)).otherwise(F.col(text)), "notes": F.when(at > 0, F.col(text).substr(at + len(separator), F.length(text)))})


def heading_paths(df: DataFrame, key: str, order: str, level: str, title: str, levels: int = 6) -> DataFrame:
    """df with `path`: the titles that a row stands under, outermost first, its own included.

    A level's last title counts if none of a smaller level came after it. Levels are few, so each is one column of the
    same window.
    """
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    place = F.row_number().over(Window.partitionBy(key).orderBy(order))
    df = df.withColumn("place_", place)
    last = [F.last(F.when(F.col(level) == k, F.struct(F.col("place_").alias("at"), F.col(title).alias("t"))), ignorenulls=True).over(w) for k in range(1, levels + 1)]
    df = df.withColumns({f"h{k}_": c for k, c in enumerate(last, 1)})
    counts = []
    for k in range(1, levels + 1):
        above = [F.coalesce(F.col(f"h{j}_.at"), F.lit(0)) for j in range(1, k)]
        newest = F.lit(0) if not above else above[0] if len(above) == 1 else F.greatest(*above)
        counts.append(F.when(F.col(f"h{k}_.at") > newest, F.col(f"h{k}_.t")))
    return df.withColumn("path", F.array_compact(F.array(*counts))).drop("place_", *[f"h{k}_" for k in range(1, levels + 1)])


def numbered(df: DataFrame, key: str, order: str, anchors: DataFrame, anchor_at: str, anchor_number: str) -> DataFrame:
    """df with its place in the key, and a printed number: that of the last anchor at or before the place, counted on from
    there; null before the first anchor. Anchors (key, anchor_at, anchor_number) join the rows as one more ordered input."""
    placed = df.withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy(order)))
    a = anchors.select(F.col(key).alias("a_key"), F.col(anchor_at).alias("a_at"), F.col(anchor_number).alias("a_number"))
    joined = placed.join(a, (F.col(key) == F.col("a_key")) & (F.col("place") == F.col("a_at")), "left")
    w = Window.partitionBy(key).orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    base = F.last(F.when(F.col("a_at").isNotNull(), F.col("a_number") - F.col("place")), ignorenulls=True).over(w)
    return joined.withColumn("printed", base + F.col("place")).drop("a_key", "a_at", "a_number")


def verse_lines(lines: DataFrame, key: str = "path", order: str = "line", text: str = "value", opening: str = "", keeps: tuple[int, ...] = (1, 9)) -> DataFrame:
    """(sura, aya, text) of `# s | a | text` lines with the lines after them; other lines before the first are dropped.

    An opening formula is taken off each first verse, but for the suras of `keeps`.
    """
    w = Window.partitionBy(key).orderBy(order)
    pattern = r"^# *(\d+) *\| *(\d+) *\| ?(.*)$"
    t = F.col(text)
    df = lines.withColumn("unit", F.sum(F.when(t.rlike(pattern), 1).otherwise(0)).over(w)).where("unit > 0")
    part = F.when(t.rlike(pattern), F.regexp_extract(t, pattern, 3)).otherwise(t)
    df = df.withColumns({"part": part, "sura": F.regexp_extract(t, pattern, 1), "aya": F.regexp_extract(t, pattern, 2)})
    parts = F.transform(F.sort_array(F.collect_list(F.struct(order, "part"))), lambda x: x["part"])
    out = df.groupBy(key, "unit").agg(F.min_by("sura", order).cast("int").alias("sura"), F.min_by("aya", order).cast("int").alias("aya"), F.array_join(parts, " ").alias("text"))
    whole = F.trim("text")
    if opening:
        first = (F.col("aya") == 1) & ~F.col("sura").isin(*keeps) & F.trim("text").startswith(opening)
        whole = F.when(first, F.trim(F.substring(whole, F.lit(len(opening) + 1), F.length("text")))).otherwise(whole)
    return out.select("sura", "aya", whole.alias("text"))


def counted(df: DataFrame, expected: int) -> DataFrame:
    """df, if it has as many rows as expected; else any use of it fails."""
    n = df.agg(F.count("*").alias("n_")).select(F.when(F.col("n_") == expected, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit(f"not {expected} rows but "), F.col("n_").cast("string"))).cast("boolean")).alias("ok_"))
    return df.crossJoin(F.broadcast(n)).where("ok_").drop("ok_")  # one row


def marked_verdicts(lines: DataFrame, key: str, order: str, text: str, number: str, mark: str, more: int = 3) -> DataFrame:
    """(key, number, text, verdict): entries that open with a number line; the text up to the first line that `mark`
    matches, and the verdict from there on over at most `more` further lines."""
    w = Window.partitionBy(key).orderBy(order)
    t = F.col(text)
    df = lines.withColumn("unit", F.sum(F.when(t.rlike(number), 1).otherwise(0)).over(w)).where("unit > 0")
    inside = Window.partitionBy(key, "unit").orderBy(order)
    df = df.withColumn("since", F.sum(F.when(t.rlike(mark), 1).otherwise(0)).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    df = df.withColumn("after", F.sum(F.when(F.col("since") > 0, 1).otherwise(0)).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    joined = lambda c: F.array_join(F.transform(F.sort_array(F.collect_list(F.when(c, F.struct(order, text)))), lambda x: x[text]), " ")
    out = df.groupBy(key, "unit").agg(F.min_by(F.regexp_extract(t, number, 1), order).alias("number"), joined(F.col("since") == 0).alias("text"), joined(F.col("after").between(1, more + 1)).alias("verdict"))
    return out.select(key, "unit", "number", "text", "verdict")


def imported(spark: SparkSession, catalog: list[tuple[str, str, str, str]]) -> DataFrame:
    """(work, record as JSON) of every work of a catalog of (work, format, path, schema); a missing table is empty."""
    out = None
    for work, kind, path, schema in catalog:
        df = tab_separated(spark, path, schema) if kind == "tsv" else json_lines(spark, path, schema, glob="*").drop(CORRUPT, "path")
        part = df.select(F.lit(work).alias("work"), F.to_json(F.struct(*df.columns)).alias("record"))
        out = part if out is None else out.unionByName(part)
    return out


def import_works(files: DataFrame, catalog: DataFrame, target: str) -> DataFrame:
    """Imports marked-up works: each file (path, content) that the catalogue (work, path, sha256) lists is checked, parsed and
    written as JSON lines, a folder for each work; returns the manifest (work, path, sha256, records).

    A file with another sum than the catalogue's fails the job before anything of it is written.
    """
    good = verified(files.join(catalog.select("path"), "path", "left_semi"), catalog.select("path", "sha256")).join(catalog, "path")
    lines = good.select("work", "path", F.posexplode(F.split(F.col("content").cast("string"), "\r?\n")).alias("line", "value"))
    units = marked_up(lines).join(catalog.select("path", "work"), "path")
    record = F.to_json(F.struct(F.concat_ws(":", "work", "unit").alias("id"), "work", "kind", "level", "page_before", "text"))
    units.select("work", record.alias("value")).write.mode("overwrite").partitionBy("work").option("compression", "gzip").text(target)
    n = files.sparkSession.read.text(target).groupBy("work").agg(F.count("*").alias("records"))
    return catalog.join(n, "work", "left").select("work", "path", "sha256", F.coalesce("records", F.lit(0)).alias("records"))

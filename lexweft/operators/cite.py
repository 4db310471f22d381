"""Record fetch: an id's record, and the page or pages of a phrase in it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.profiles import LATIN, Profile


def folder_of(record_id: Column | str) -> Column:
    """The folder that an id names: `urn:kind:folder.book...:rest` stands in `folder`. Null for other ids, which may stand anywhere."""
    c = F.col(record_id) if isinstance(record_id, str) else record_id
    third = F.get(F.split(c, ":"), F.lit(2))
    return F.when(c.startswith("urn:") & F.contains(third, F.lit(".")), F.substring_index(third, ".", 1))


def fetched(records: DataFrame, wanted: DataFrame) -> DataFrame:
    """The records (id, folder, ...) of wanted ids (id, ...): where an id names a folder that is there only that one is read,
    others are looked for in all of them."""
    w = wanted.withColumn("folder_", folder_of("id"))
    routed = records.join(w, (records["folder"] == w["folder_"]) & (records["id"] == w["id"])).drop(w["id"]).drop("folder_")
    rest = w.join(routed.select(F.col("id").alias("r_")).distinct(), F.col("id") == F.col("r_"), "left_anti").drop("folder_")
    return routed.unionByName(records.join(rest, "id").select(*routed.columns))


def resolved_ids(wanted: DataFrame, hadith: DataFrame) -> DataFrame:
    """wanted (id, phrase) with `asked`, the id as it was given, and `id`, the source paragraph of a hadith's id (hadith: id,
    number, source_ids) or the id itself. An id of the layer that isn't there has a null id."""
    h = hadith.select(F.col("id").alias("h_id"), F.col("number").cast("string").alias("number"), F.get("source_ids", F.lit(0)).alias("source"), F.lit(True).alias("found"))
    out = wanted.select(F.col("id").alias("asked"), "phrase").join(h, F.col("asked") == F.col("h_id"), "left")
    own = ~F.col("asked").startswith("urn:hadith:")
    return out.select("asked", "phrase", "number", F.when(own, F.col("asked")).otherwise(F.col("source")).alias("id"), (own | F.coalesce("found", F.lit(False))).alias("known"))


def cite(records: DataFrame, wanted: DataFrame, p: Profile = LATIN) -> DataFrame:
    """(id, phrase, kind, loc) for records (id, folder, text, hemistichs, vol, page_before, other locators) that are wanted.

    verse: a couplet is cited by its numbers. locator: a record without page marks by what it has. pages: without a phrase,
    the first and the last page. on: the pages that have the phrase. across: the pages it runs over, from the first one with
    its first word. missing: the phrase isn't there. absent: there is no such record.
    """
    found = fetched(records, wanted)
    fields = [c for c in ("vol", "part", "page", "leaf", "printed_page", "poem_number", "seq") if c in records.columns]
    locator = T.locator({c: F.col(c) for c in fields})
    q = T.clean("phrase", p)
    segs = found.withColumn("segs", F.transform(T.exact_pages(F.col("text"), F.col("vol"), F.col("page_before")), lambda s: F.struct(T.page_name(s["vol"], s["page"]).alias("page"), T.clean(s["text"], p).alias("text"))))
    segs = segs.withColumn("q", q).withColumn("on", F.transform(F.filter("segs", lambda s: F.contains(s["text"], F.col("q"))), lambda s: s["page"]))
    upto = F.aggregate(
        "segs", F.struct(F.lit("").alias("all"), F.lit(None).cast("string").alias("start"), F.lit(None).cast("string").alias("stop")),
        lambda a, s: F.struct(
            F.trim(F.concat_ws(" ", a["all"], F.when(s["text"] != "", s["text"]))).alias("all"),
            F.coalesce(a["start"], F.when(F.contains(s["text"], F.substring_index("q", " ", 1)), s["page"])).alias("start"),
            F.coalesce(a["stop"], F.when(F.contains(F.concat_ws(" ", a["all"], F.when(s["text"] != "", s["text"])), F.col("q")), s["page"])).alias("stop"),
        ),
    )
    segs = segs.withColumn("across", upto)
    verse = F.coalesce(F.size("hemistichs"), F.lit(0)) > 0
    asked = F.coalesce("q", F.lit("")) != ""
    kind = F.when(verse, "verse").when(F.col("page_before").isNull(), "locator").when(~asked, "pages").when(F.size("on") > 0, "on").when(F.col("across.stop").isNotNull(), "across").otherwise("missing")
    ends = F.concat_ws(" to ", F.element_at("segs", 1)["page"], F.element_at("segs", -1)["page"])
    loc = F.when(kind.isin("verse", "locator"), locator).when(kind == "pages", ends).when(kind == "on", F.array_join("on", ", ")).when(kind == "across", F.concat_ws("-", F.coalesce("across.start", F.lit("?")), "across.stop")).otherwise("")
    cited = segs.select("id", "phrase", kind.alias("kind"), loc.alias("loc"))
    absent = wanted.join(cited.select(F.col("id").alias("c_")).distinct(), F.col("id").eqNullSafe(F.col("c_")), "left_anti")
    return cited.unionByName(absent.select("id", "phrase", F.lit("absent").alias("kind"), F.lit("").alias("loc")))

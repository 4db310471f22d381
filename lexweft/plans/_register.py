"""How a query is registered: its name, and SQL for the rows it returns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions.profiles import LATIN

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def norm_sql(col: str = "text") -> str:
    """A text column as functions.text.norm gives it under the Latin profile."""
    return rf"translate(lower(regexp_replace(coalesce({col}, ''), '[\x{{0300}}-\x{{036F}}\x{{00AD}}]', '', 'g')), '{LATIN.fold_from}', '{LATIN.fold_to}')"


def clean_sql(col: str = "text") -> str:
    return rf"trim(regexp_replace({norm_sql(col)}, '[^\p{{L}}]+', ' ', 'g'))"


def tok_sql(col: str = "text") -> str:
    """The tokens of a text column, as functions.text.tokens gives them."""
    return rf"regexp_extract_all({norm_sql(col)}, '[\p{{L}}\p{{N}}]+')"


def list_sql(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in sorted(words)) + "]"


def toks_sql(col: str = "text") -> str:
    """The tokens of two letters or more that are not in the stop list, as functions.text.content gives them."""
    return f"list_filter({tok_sql(col)}, lambda w: length(w) >= 2 AND NOT list_contains({list_sql(LATIN.stop)}, w))"


def stems_sql(col: str = "text") -> str:
    """The stems of a text column, as functions.text.stems gives them."""
    words = f"list_transform(list_filter(string_split({clean_sql(col)}, ' '), lambda w: w <> ''), lambda w: regexp_replace(w, '^(?:un|re)?(.{{3,}})$', '\\1'))"
    return f"list_transform(list_transform({words}, lambda w: CASE WHEN length(w) >= 4 AND w[-1] = 's' THEN w[:-2] ELSE w END), lambda w: CASE WHEN w = 'dont' THEN 'do' ELSE w END)"


def posts_sql(source: str = "documents", key: str = "doc_id", text: str = "text", toks=tok_sql) -> str:
    return f"(SELECT {key} AS uid, unnest(t) AS term, unnest(range(len(t))) AS pos FROM (SELECT {key}, {toks(text)} AS t FROM {source}))"


def gram_sql(source: str, key: str, k: int, text: str = "text", extra: str = "", toks=tok_sql) -> str:
    """(key, gram), each once."""
    join = " || ' ' || ".join(f"t[i + {j}]" if j else "t[i]" for j in range(k))
    return f"(SELECT DISTINCT {key} AS key{extra}, unnest(list_transform(range(1, len(t) - {k - 2}), lambda i: {join})) AS gram FROM (SELECT *, {toks(text)} AS t FROM {source}))"


#: The table of the CRC-32 sum, as a table `crc` of a WITH clause, for crc_sql.
CRC_TABLE = "crc AS (SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS tbl)"


def crc_sql(text: str) -> str:
    """The CRC-32 sum of a text's UTF-8 bytes, where crc is joined."""
    code = f"list_transform(range(0, octet_length(encode({text}))), lambda k: CAST('0x' || substr(hex(encode({text})), CAST(2 * k + 1 AS BIGINT), 2) AS BIGINT))"
    return f"xor(list_reduce(list_concat([4294967295], {code}), lambda c, b: xor(c >> 8, tbl[(xor(c, b) & 255) + 1])), 4294967295)"

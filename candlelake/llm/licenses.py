"""License scan by canonical digests: texts that are a known licence as a whole, and licence statements inside texts.

Texts are brought to one form: lower case, no copyright lines, words without
punctuation, one of several equivalent spellings. The digest of that form is looked up in the digests of
the known texts by a hash join; the known side is a stored table of digests, of fixed size, so no licence text travels with a plan.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlelake.llm.license_texts import LICENSES, SPELLINGS
from candlelake.llm.stages import stage

# a line that names a holder or a year, not a sentence about copyright
COPYRIGHT_LINE = (
    r"(^|\n)[^\p{L}\n]*(copyright[^\p{L}\n]*(\(c\)|©|[0-9]{4}|<year|\[y|\{y)|\(c\)[^\p{L}\n]*[0-9]{4}|©|all rights reserved)[^\n]*"
)
PUNCTUATION = r"[^\p{L}\p{N}]+"


def _steps() -> list[tuple[str, str]]:
    """Patterns and replacements, applied in turn to a lower-case text."""
    return [(COPYRIGHT_LINE, "\n"), (PUNCTUATION, " ")] + [(rf"\b{a}\b", b) for a, b in SPELLINGS]


def canonical(text: Column) -> Column:
    out = F.lower(text)
    for pattern, replacement in _steps():
        out = F.regexp_replace(out, F.lit(pattern), F.lit(replacement))
    return F.trim(out)


def _table(spark, texts: list[tuple[str, str]]) -> DataFrame:
    rows = json.dumps([{"license": name, "text": text} for name, text in texts])
    return spark.range(1).select(F.inline(F.from_json(F.lit(rows), "array<struct<license:string,text:string>>")))


def known(spark, texts: list[tuple[str, str]]) -> DataFrame:
    """``license, digest`` of known texts; of names with equal digests the least counts."""
    table = _table(spark, texts)
    return table.groupBy(F.sha2(canonical(F.col("text")), 256).alias("digest")).agg(F.min("license").alias("license"))


def scan(docs: DataFrame, texts: list[tuple[str, str]] | None = None) -> DataFrame:
    """``doc_id, canonical_sha256, license`` of every row: the name of the licence that the whole text is, or null.

    A null text is empty and no licence. Rows that repeat are scanned one by one. An empty table gives no rows.
    """
    digests = F.broadcast(stage(known(docs.sparkSession, LICENSES if texts is None else texts), "licence-digests"))
    text = F.coalesce(F.col("text"), F.lit(""))
    marked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.sha2(canonical(text), 256).alias("canonical_sha256"))
    return marked.join(digests, F.col("canonical_sha256") == F.col("digest"), "left").select("doc_id", "canonical_sha256", "license")


# words that a paragraph of a longer licence must have to stand for it
LEAST_WORDS = 8
# characters up to which single lines of a known text stand for it; lines of longer texts are mere fragments
SHORT_TEXT = 2500
_LINES, _PARAGRAPHS = r"\n", r"\n[^\S\n]*\n\s*"


def _pieces(text: Column) -> Column:
    """Lines, and paragraphs of more than one line, with what they are and their number from 1."""

    def numbered(kind: str, pattern: str) -> Column:
        parts = F.split(text, pattern)
        return F.transform(parts, lambda p, i: F.struct(F.lit(kind).alias("kind"), (i + 1).alias("number"), p.alias("piece")))

    paragraphs = F.filter(numbered("paragraph", _PARAGRAPHS), lambda p: F.contains(F.trim(p["piece"], F.lit("\n")), F.lit("\n")))
    return F.concat(numbered("line", _LINES), paragraphs)


def known_pieces(spark, texts: list[tuple[str, str]]) -> DataFrame:
    """``digest, license`` of whole known texts, of their paragraphs and, if short, their lines of ``LEAST_WORDS`` words; several names are joined."""
    table = _table(spark, texts)
    pieces = table.select("license", F.length("text").alias("n"), F.inline(_pieces(F.col("text"))))
    inner = pieces.where((F.col("kind") == "paragraph") | (F.col("n") < SHORT_TEXT)).select("license", F.col("piece").alias("text"))
    forms = table.select("license", canonical(F.col("text")).alias("form")).union(
        inner.select("license", canonical(F.col("text")).alias("form")).where(F.size(F.split("form", " ")) >= LEAST_WORDS)
    )
    return forms.groupBy(F.sha2("form", 256).alias("digest")).agg(F.array_join(F.sort_array(F.collect_set("license")), " or ").alias("license"))


def statements(docs: DataFrame, texts: list[tuple[str, str]] | None = None) -> DataFrame:
    """``doc_id, kind, number, license`` of every line, and paragraph of several lines, that states a known licence.

    It is a known text, or a line or paragraph of one; of several licences that share it, all are named. Rows that repeat are scanned one
    by one. Null and empty texts and an empty table give no rows.
    """
    digests = F.broadcast(stage(known_pieces(docs.sparkSession, LICENSES if texts is None else texts), "licence-digests"))
    pieces = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.inline(_pieces(F.col("text"))))
    marked = pieces.select("doc_id", "kind", "number", F.sha2(canonical(F.col("piece")), 256).alias("digest"))
    return marked.join(digests, "digest").select("doc_id", "kind", "number", "license")


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def oracle(texts: list[tuple[str, str]] = LICENSES) -> str:
    """The scan of ``documents`` as SQL."""

    def form(column: str) -> str:
        out = f"lower({column})"
        for pattern, replacement in _steps():
            out = f"regexp_replace({out}, {_sql_text(pattern)}, {_sql_text(replacement)}, 'g')"
        return f"sha256(trim({out}))"

    values = ", ".join(f"({_sql_text(name)}, {_sql_text(text)})" for name, text in texts)
    return f"""
        WITH known AS (
            SELECT {form("body")} AS digest, min(name) AS license FROM (VALUES {values}) AS t(name, body) GROUP BY 1
        ), marked AS (
            SELECT CAST(doc_id AS BIGINT) AS doc_id, {form("coalesce(text, '')")} AS canonical_sha256 FROM documents
        )
        SELECT doc_id, canonical_sha256, license FROM marked LEFT JOIN known ON canonical_sha256 = digest
    """


def statements_oracle(texts: list[tuple[str, str]] = LICENSES) -> str:
    """The statements of ``documents`` as SQL."""

    def form(column: str) -> str:
        out = f"lower({column})"
        for pattern, replacement in _steps():
            out = f"regexp_replace({out}, {_sql_text(pattern)}, {_sql_text(replacement)}, 'g')"
        return f"trim({out})"

    def pieces(source: str, columns: str) -> str:
        def part(kind: str, pattern: str) -> str:
            split = f"string_split_regex(body, {_sql_text(pattern)})"
            return f"SELECT {columns}, '{kind}' AS kind, unnest({split}) AS piece, generate_subscripts({split}, 1) AS number FROM {source}"

        multi = f"SELECT * FROM ({part('paragraph', _PARAGRAPHS)}) WHERE contains(trim(piece, chr(10)), chr(10))"
        return f"{part('line', _LINES)} UNION ALL {multi}"

    values = ", ".join(f"({_sql_text(name)}, {_sql_text(text)})" for name, text in texts)
    return f"""
        WITH texts AS (SELECT * FROM (VALUES {values}) AS t(name, body)),
        inner_forms AS (
            SELECT name, {form("piece")} AS form FROM ({pieces("texts", "name, body")}) WHERE kind = 'paragraph' OR length(body) < {SHORT_TEXT}
        ),
        forms AS (
            SELECT name, {form("body")} AS form FROM texts
            UNION ALL SELECT name, form FROM inner_forms WHERE len(string_split(form, ' ')) >= {LEAST_WORDS}
        ),
        known AS (SELECT sha256(form) AS digest, string_agg(DISTINCT name, ' or ' ORDER BY name) AS license FROM forms GROUP BY 1),
        docs AS (SELECT CAST(doc_id AS BIGINT) AS doc_id, text AS body FROM documents)
        SELECT doc_id, kind, CAST(number AS INTEGER) AS number, license
        FROM (SELECT doc_id, kind, number, sha256({form("piece")}) AS digest FROM ({pieces("docs", "doc_id")})) JOIN known USING (digest)
    """

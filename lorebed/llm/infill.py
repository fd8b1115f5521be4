"""Fill-in-the-middle: a text is cut into prefix, middle and suffix by one match of a pattern that counts units, and put together in another order."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .job import set_apart, text_or_empty

#: One code point, line ends included.
CODE_POINT = r"(?s:.)"
#: One line with its end, or the last one without.
LINE = r"(?:[^\n]*+\n|[^\n]++)"


class Marks(NamedTuple):
    """What stands before each part in the output; a text with one of them stays plain."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"


def _quoted(mark: str) -> str:
    """A mark as a pattern."""
    return "".join(c if c.isalnum() or c == "_" else f"\\x{{{ord(c):x}}}" for c in mark)


def _kept(mark: str) -> str:
    """A mark in a replacement, where ``$`` and ``\\`` have a meaning."""
    return mark.replace("\\", r"\\").replace("$", r"\$")


def _number(text: Column, at: int) -> Column:
    """The eight hexadecimal digits from a place on, as an unsigned number."""
    return F.conv(F.substring(text, 8 * at + 1, 8), 16, 10).cast("long")


def fill_in_middle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = CODE_POINT, seed: int = 1, plain_from: int = 90,
    spm_below: int = 20, marks: Marks = Marks()
) -> DataFrame:
    """Every row with ``n`` units, ``form`` (plain, psm or spm), ``prefix_units``, ``middle_units`` and ``output``; its own columns of these names are replaced.

    ``regexp_count`` gives n, and each row gets a pattern of its own: the units up to the first cut, those up to the second and the rest, each in a group with
    a counted possessive quantifier, so that one match without a step back fills the parts into the output. ``unit`` is a pattern whose
    matches, from left to right, make up the text: CODE_POINT or LINE.

    The numbers h1 to h4 are from the sha256 of ``<seed>:<id>``. Cuts are at h1 and h2 modulo n + 1; the form is plain for an empty text, one
    with a mark, or h3 modulo 100 from ``plain_from`` up, else spm for h4 modulo 100 below ``spm_below``, else psm. A null text is empty,
    a null id is an empty number; rows that share an id are cut by the same numbers. Equal rows have equal results. Rows don't move.
    """
    columns = [c for c in docs.columns if c not in ("n", "form", "prefix_units", "middle_units", "output")]
    rows = set_apart(docs, {id_col, text_col})
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    text = text_or_empty(text_col)
    marked = F.lit(False)
    for mark in marks:
        marked = marked | F.contains(text, F.lit(mark))
    rows = rows.withColumn("__hash", hashed).withColumn("__n", F.regexp_count(text, F.lit(unit)).cast("long"))
    h = [_number(F.col("__hash"), k) for k in range(4)]
    cuts = [x % (F.col("__n") + 1) for x in h[:2]]
    rows = rows.withColumns(
        {
            "__a": F.least(*cuts), "__b": F.greatest(*cuts),
            "__form": F.when((text == "") | marked | (h[2] % 100 >= plain_from), "plain").when(h[3] % 100 < spm_below, "spm").otherwise("psm"),
        }
    )
    counted = lambda k: F.concat(F.lit(f"((?:{unit}){{"), k.cast("string"), F.lit("}+)"))
    pattern = F.concat(F.lit(r"\A"), counted(F.col("__a")), counted(F.col("__b") - F.col("__a")), F.lit(r"((?s:.)*+)\z"))
    p, s, m = map(_kept, marks)
    order = F.when(F.col("__form") == "spm", f"{s}$3{p}$1{m}$2").otherwise(f"{p}$1{s}$3{m}$2")
    cut = F.col("__form") != "plain"
    rows = rows.withColumn("__output", F.when(cut, F.regexp_replace(text, pattern, order)).otherwise(text))
    own = dict(zip(docs.columns, rows.columns))
    return rows.select(
        *[F.col(own[c]).alias(c) for c in columns], F.col("__n").alias("n"), F.col("__form").alias("form"), F.when(cut, F.col("__a")).alias("prefix_units"),
        F.when(cut, F.col("__b") - F.col("__a")).alias("middle_units"), F.col("__output").alias("output"),
    )


def restored(output: str = "output", form: str = "form", marks: Marks = Marks()) -> Column:
    """The text that an output and its form come from. No part has a mark in it, so each mark of the output is where it was put."""
    p, s, m = map(_quoted, marks)
    rest = r"((?s:.)*?)"
    psm = F.regexp_replace(output, F.lit(rf"\A{p}{rest}{s}{rest}{m}((?s:.)*+)\z"), F.lit("$1$3$2"))
    spm = F.regexp_replace(output, F.lit(rf"\A{s}{rest}{p}{rest}{m}((?s:.)*+)\z"), F.lit("$2$3$1"))
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(F.col(output))


def duckdb_sql(seed: int = 1, plain_from: int = 90, spm_below: int = 20, marks: Marks = Marks()) -> str:
    """The query in DuckDB: parts by their places, not by a pattern; the restored text is put together from the output's parts."""
    p, s, m = marks
    number = lambda k: f"('0x' || substr(h, {8 * k + 1}, 8))::BIGINT"
    between = lambda a, b: f"substr(output, strpos(output, '{a}') + {len(a)}, strpos(output, '{b}') - strpos(output, '{a}') - {len(a)})"
    after = f"substr(output, strpos(output, '{m}') + {len(m)})"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('{seed}:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
c AS (
  SELECT doc_id, text, length(text) AS n, {number(0)} % (length(text) + 1) AS c1, {number(1)} % (length(text) + 1) AS c2,
    CASE WHEN text = '' OR contains(text, '{p}') OR contains(text, '{s}') OR contains(text, '{m}') OR {number(2)} % 100 >= {plain_from} THEN 'plain'
      WHEN {number(3)} % 100 < {spm_below} THEN 'spm' ELSE 'psm' END AS form
  FROM d
),
t AS (
  SELECT *, least(c1, c2) AS a, greatest(c1, c2) AS b, substr(text, 1, least(c1, c2)) AS prefix,
    substr(text, least(c1, c2) + 1, greatest(c1, c2) - least(c1, c2)) AS middle, substr(text, greatest(c1, c2) + 1) AS suffix
  FROM c
),
o AS (
  SELECT *, CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '{p}' || prefix || '{s}' || suffix || '{m}' || middle
    ELSE '{s}' || suffix || '{p}' || prefix || '{m}' || middle END AS output
  FROM t
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN a END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END::BIGINT AS middle_chars,
  sha256(output) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN output WHEN 'psm' THEN {between(p, s)} || {after} || {between(s, m)} ELSE {between(p, m)} || {after} || {between(s, p)} END) AS restored_sha256
FROM o
"""

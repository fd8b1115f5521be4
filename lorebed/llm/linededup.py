"""Line dedup by a log-template tree of fixed depth.

A line goes down the tree by its number of tokens and its first ``depth`` tokens; a token with a digit is a variable
field and goes down as ``<*>``. In its leaf, a token is constant if at least ``min_docs`` different documents have it at that place in a line of the
leaf, else it is a variable field too. What is constant makes the line's template. A template that recurs in ``min_docs`` documents is
dropped from all of them but the first. A line that recurs token by token needs fewer: it is dropped from ``exact_docs`` documents on.
A document counts once, however often it repeats a line or a token.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .job import discard, keyed, set_apart, ship, spread_join, stored
from .textblocks import SPACED, U64, hash_spans, mix, text_blocks, word_spans

FIELD = "<*>"
_DIGIT = re.compile(b"[0-9]")


def _lines(data: np.ndarray, offsets: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each line its text, its place in it from 0, its number of tokens, whether one is a field, and a hash of its leaf."""
    ends = np.flatnonzero(data == 10)
    text = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, ends, "right") - 1])
    start = np.concatenate([offsets[:-1], ends + 1])
    order = np.lexsort((start, text))
    text, start = text[order], start[order]
    place = np.arange(len(text)) - np.searchsorted(text, np.arange(len(offsets) - 1))[text]
    begin, end, _ = word_spans(data, offsets, SPACED)
    first = np.searchsorted(begin, start)
    n = np.diff(np.append(first, len(begin)))
    digits = np.flatnonzero(data - np.uint8(48) < 10)
    field = np.zeros(len(text), dtype=bool)
    field[np.searchsorted(start, digits, "right") - 1] = True
    # A leaf asks for the first tokens of its lines alone, so their bytes are laid end to end and hashed without the others.
    having = [np.flatnonzero(n > k) for k in range(depth)]
    head = np.sort(np.concatenate([first[has] + k for k, has in enumerate(having)] or [first[:0]]))
    begin, end = begin[head], end[head]
    edge = np.zeros(len(data) + 1, dtype=np.int8)
    edge[begin] += 1
    edge[end] -= 1
    last = np.cumsum(end - begin)
    hashes = hash_spans(data[np.cumsum(edge[:-1], dtype=np.int8).view(bool)], last - (end - begin), last)
    hashes[np.searchsorted(digits, end) > np.searchsorted(digits, begin)] = U64(1)
    at = np.cumsum(np.minimum(n, depth)) - np.minimum(n, depth)
    leaf = n.astype(U64) * U64(0x9E3779B97F4A7C15)
    for k, has in enumerate(having):
        leaf[has] = mix(leaf[has] + hashes[at[has] + k])
    return text, place, n, field, leaf


def _named(*parts: bytes) -> bytes:
    """16 bytes that stand for some texts without spaces at their ends."""
    return blake2b(b" ".join(parts), digest_size=16).digest()


def _described(line: bytes, depth: int) -> tuple[int, bytes, bytes, bytes, bytes]:
    """A line's number of tokens, the names of its leaf and of its masked form, that form, and the name of the line itself."""
    tokens = line.split()  # of bytes: at 0x09 to 0x0D and 0x20
    masked = [FIELD.encode() if _DIGIT.search(t) else t for t in tokens] if _DIGIT.search(line) else tokens
    n = b"%d" % len(tokens)
    return len(tokens), _named(n, *masked[:depth]), _named(n, *masked), b" ".join(masked), _named(*tokens)


def dropped_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = 3, min_docs: int = 3, min_tokens: int = 4,
    similarity: float = 0.5, exact_docs: int | None = 2, short_docs: int = 3
) -> DataFrame:
    """(key of the row, places of its dropped lines from 0, ascending), for rows with any.

    A line with fewer than ``min_tokens`` tokens, or a template of which less than ``similarity`` is constant, is not dropped as a template.
    A line that ``exact_docs`` documents have with the same tokens is dropped too; one with fewer than ``min_tokens`` has to be in ``short_docs``
    documents and to be without a digit. With ``exact_docs`` None only templates count.
    Rows with one id and different texts are different documents; rows alike in both are one. The first document of a template is the
    one with the smallest id (null before all), then the smallest key.
    """
    rows = docs.select(keyed(id_col, text_col).alias("key"), F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, _, data, offsets in text_blocks(batch.column(1)):
                text, place, n, field, leaf = _lines(data, offsets, depth)
                own = counted(n, field)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaf[own].view(np.int64)), batch.column(0).take(pa.array(first + text[own])), pa.array(place[own].astype(np.int32))],
                    names=["leaf", "key", "place"]
                )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, _, _ in text_blocks(batch.column(2)):
                yield described(batch.slice(first, last - first))

    def described(rows: pa.RecordBatch) -> pa.RecordBatch:
        """The wanted lines of a block of texts; as Python's own texts take several times their bytes, no more of them at once."""
        place, told, known = [], [], {}
        sizes = rows.column(3).value_lengths().to_numpy()
        all_wanted, at = rows.column(3).flatten().to_pylist(), 0
        for text, size in zip(rows.column(2).cast(pa.binary()), sizes.tolist()):
            lines, wanted = text.as_py().split(b"\n"), sorted(all_wanted[at : at + size])
            at += size
            place.extend(wanted)
            for line in map(lines.__getitem__, wanted):
                if line not in known:
                    known[line] = _described(line, depth)
                told.append(known[line])
        n, leaf, form, line, same = zip(*told) if told else ((),) * 5
        row = pa.array(np.repeat(np.arange(len(sizes)), sizes))
        columns = [
            rows.column(0).take(row), rows.column(1).take(row), pa.array(place, pa.int32()), pa.array(n, pa.int32()),
            *(pa.array(x, pa.binary()) for x in (leaf, form)), pa.array(line, pa.string()), pa.array(same, pa.binary())
        ]
        return pa.RecordBatch.from_arrays(columns, names=["key", "id", "place", "n", "leaf", "form", "line", "same"])

    def counted(n: np.ndarray, field: np.ndarray) -> np.ndarray:
        return np.flatnonzero((n >= min_tokens) | (n > 0) & ~field & (exact_docs is not None))

    ship(docs.sparkSession)
    least = min_docs if exact_docs is None else min(min_docs, exact_docs, short_docs)
    # A leaf with fewer lines than documents wanted has no recurring line or template; all else concerns the lines of busy leaves, a small part of the text.
    dealt = stored(rows.select("key", "text").mapInArrow(places, "leaf long, key binary, place int"))
    busy = dealt.groupBy("leaf").agg(F.count("*").alias("seen")).where(F.col("seen") >= least).select("leaf")
    wanted = spread_join(dealt, busy, ["leaf"], how="left_semi")
    wanted = stored(wanted.groupBy("key").agg(F.collect_set("place").alias("wanted")))
    discard(dealt)
    kind = docs.schema[id_col].dataType.simpleString()
    lines = stored(
        rows.join(wanted.hint("merge"), "key").select("key", "id", "text", "wanted").mapInArrow(cut, f"key binary, id {kind}, place int, n int, leaf binary, form binary, line string, same binary")
    )
    discard(wanted)
    long = lines.where(F.col("n") >= min_tokens)
    having = stored(long.select("form", "key").distinct())
    forms = long.groupBy("form").agg(F.first("leaf").alias("leaf"), F.first("n").alias("n"), F.first("line").alias("line"))
    forms = forms.join(having.groupBy("form").agg(F.count("*").alias("docs")), "form")
    forms = stored(forms.withColumn("form_id", F.monotonically_increasing_id()))
    # Only a leaf that enough documents share can have a template that recurs in as many.
    shared = forms.groupBy("leaf").agg(F.sum("docs").alias("all")).where(F.col("all") >= min_docs).select("leaf")
    open_forms = stored(forms.join(shared, "leaf", "left_semi"))
    discard(forms)
    templates = stored(_templates(open_forms, having, depth, min_docs, similarity))
    found = spread_join(long.select("key", "id", "place", "form"), templates, ["form"]).select(
        "key", "id", "place", "template", F.lit(min_docs).alias("needed")
    )
    if exact_docs is not None:
        needed = F.when(F.col("n") >= min_tokens, exact_docs).otherwise(short_docs)
        found = found.unionByName(lines.select("key", "id", "place", F.concat(F.lit(b"="), "same").alias("template"), needed.alias("needed")))
    found = stored(found)
    once = found.groupBy("template", "needed", "id", "key").agg(F.lit(1).alias("one"))
    recurring = once.groupBy("template", "needed").agg(
        F.count("*").alias("docs"), F.min(F.struct("id", "key")).alias("first")
    ).where(F.col("docs") >= F.col("needed")).select("template", F.col("first.key").alias("first"))
    dropped = spread_join(found.select("key", "place", "template"), recurring, ["template"]).where(F.col("key") != F.col("first"))
    gone = stored(dropped.groupBy("key").agg(F.array_sort(F.collect_set("place")).alias("places")))
    discard(lines, having, open_forms, templates, found)
    return gone


def _templates(forms: DataFrame, having: DataFrame, depth: int, min_docs: int, similarity: float) -> DataFrame:
    """(form, template's name) of the forms of which enough is constant. ``forms`` has form, form_id, leaf, n, line and docs; ``having`` which key has which form."""
    # A token's row is short, however long its line.
    tail = forms.select(
        "form_id", "leaf", "docs", F.posexplode(F.split("line", " ")).alias("at", "token")
    ).where((F.col("at") >= depth) & (F.col("token") != FIELD))
    token = ["leaf", "at", "token"]
    seen = tail.groupBy(*token).agg(F.max("docs").alias("most"), F.sum("docs").alias("total")).where(F.col("total") >= min_docs)
    seen = stored(seen.select(*token, (F.col("most") >= min_docs).alias("settled")))
    # A form that enough documents have settles its tokens and needs no look-up itself. The others are in few documents each, whose keys are counted without repeats.
    asked = stored(tail.where(F.col("docs") < min_docs).join(seen, token).select("form_id", *token, "settled"))
    open_ = asked.where("NOT settled").join(forms.select("form_id", "form"), "form_id").join(having, "form").groupBy(*token).agg(F.count_distinct("key").alias("docs"))
    counted = asked.where("NOT settled").join(open_.where(F.col("docs") >= min_docs), token).select("form_id", "at")
    constant = stored(asked.where("settled").select("form_id", "at").unionByName(counted).groupBy("form_id").agg(F.collect_list("at").alias("places")))
    discard(seen, asked)
    whole = forms.join(constant, "form_id", "left")
    stays = lambda t, k: (F.col("docs") >= min_docs) | (k < depth) | F.coalesce(F.array_contains("places", k), F.lit(False))
    template = F.transform(F.split("line", " "), lambda t, k: F.when(stays(t, k), t).otherwise(FIELD))
    # Counted without the template, which the filter would make a second time.
    fixed = lambda tokens: F.size(F.filter(tokens, lambda t: t != FIELD))
    tokens = F.split("line", " ")
    same = F.when(F.col("docs") >= min_docs, fixed(tokens)).otherwise(fixed(F.slice(tokens, 1, depth)) + F.coalesce(F.size("places"), F.lit(0)))
    whole = whole.where(same >= F.lit(similarity) * F.col("n")).select("form", "n", template.alias("template"))
    return whole.select("form", F.unhex(F.sha2(F.concat_ws(" ", "n", F.array_join("template", " ")), 256)).alias("template"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows without their dropped lines, with n_lines and n_dropped; input columns of these names are replaced, others keep theirs.

    A null text stays null and has no lines; an empty one has one. Every line that stays is unchanged, in its order.
    """
    ship(docs.sparkSession)
    docs = docs.drop("n_lines", "n_dropped")
    apart = set_apart(docs, {id_col, text_col})
    # Whether each line up to the last dropped one is dropped. Made before the join, so once for a row and not for each of its lines.
    gone = F.flatten(F.transform("places", lambda p, k: F.concat(F.array_repeat(F.lit(False), p - F.coalesce(F.get("places", k - 1), F.lit(-1)) - 1), F.array(F.lit(True)))))
    dropped = dropped_lines(apart, id_col, text_col, **options).select(F.col("key").alias("__key"), gone.alias("__places"), F.size("places").alias("__n_places"))
    rows = apart.withColumn("__key", keyed(id_col, text_col)).join(dropped.hint("merge"), "__key", "left")
    n_lines = F.when(F.col(text_col).isNull(), 0).otherwise(F.length(text_col) - F.length(F.replace(F.col(text_col), F.lit("\n"), F.lit(""))) + 1)
    kept = F.array_join(F.filter(F.split(text_col, "\n"), lambda line, k: ~F.coalesce(F.get("__places", k), F.lit(False))), "\n")
    rows = rows.withColumns({
        "__n": n_lines.cast("long"), "__gone": F.coalesce("__n_places", F.lit(0)).cast("long"),
        text_col: F.when(F.col("__places").isNull(), F.col(text_col)).otherwise(kept)
    })
    return rows.select(*apart.columns, "__n", "__gone").toDF(*docs.columns, "n_lines", "n_dropped")


def duckdb_sql(depth: int = 3, min_docs: int = 3, min_tokens: int = 4, similarity: float = 0.5, exact_docs: int = 2, short_docs: int = 3) -> str:
    """The same in DuckDB, for documents with distinct ids and texts that aren't null."""
    space = r"[\x09-\x0D\x20]+"
    return f"""
WITH l0 AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, unnest(range(len(string_split(text, chr(10))))) AS place FROM documents),
l1 AS (SELECT doc_id, place, list_filter(string_split_regex(raw, '{space}'), lambda t: t <> '') AS own FROM l0),
l2 AS (SELECT *, len(own) AS n, list_transform(own, lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '{FIELD}' ELSE t END) AS tokens FROM l1),
l3 AS (SELECT *, array_to_string(tokens[1:{depth}], ' ') AS head FROM l2 WHERE n >= {min_tokens}),
busy AS (SELECT n, head FROM l3 GROUP BY 1, 2 HAVING count(*) >= {min_docs}),
l AS MATERIALIZED (SELECT doc_id, place, n, head, tokens FROM l3 JOIN busy USING (n, head)),
p AS MATERIALIZED (SELECT DISTINCT doc_id, n, head, tokens, unnest(tokens) AS token, unnest(range(n)) AS place FROM l),
c AS (SELECT n, head, place, token FROM p WHERE place >= {depth} AND token <> '{FIELD}' GROUP BY 1, 2, 3, 4 HAVING count(DISTINCT doc_id) >= {min_docs}),
q AS (SELECT DISTINCT n, head, tokens, token, place FROM p),
t AS (
  SELECT n, head, tokens, string_agg(CASE WHEN q.place < {depth} OR c.token IS NOT NULL THEN q.token ELSE '{FIELD}' END, ' ' ORDER BY q.place) AS template
  FROM q LEFT JOIN c USING (n, head, place, token) GROUP BY 1, 2, 3
),
f AS (
  SELECT doc_id, place, n || ' ' || template AS what, {min_docs} AS needed FROM l JOIN t USING (n, head, tokens) WHERE len(list_filter(string_split(template, ' '), lambda x: x <> '{FIELD}')) >= {similarity} * n
  UNION ALL SELECT doc_id, place, '= ' || array_to_string(own, ' '), CASE WHEN n >= {min_tokens} THEN {exact_docs} ELSE {short_docs} END FROM l2 WHERE n > 0 AND (n >= {min_tokens} OR NOT list_contains(tokens, '{FIELD}'))
),
r AS (SELECT what, min(doc_id) AS first FROM f GROUP BY what, needed HAVING count(DISTINCT doc_id) >= needed),
g AS (SELECT DISTINCT doc_id, place FROM f JOIN r USING (what) WHERE doc_id <> first),
k AS (SELECT l0.doc_id, count(*) AS n_lines, count(g.place) AS n_dropped, coalesce(string_agg(raw, chr(10) ORDER BY place) FILTER (g.place IS NULL), '') AS kept FROM l0 LEFT JOIN g USING (doc_id, place) GROUP BY 1)
SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM k
"""

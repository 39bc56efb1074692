"""Lines that many documents share, found and marked with DataFrame operations alone.

Texts are split into lines; a line's key is the line without blanks at its ends
and with A-Z in lower case, held as 128 bits of hash. The keys are dealt by range
of (hash, document) and sorted by position within a document, so that a document's
first occurrence of a key is the first row of its run and a very common line is
spread over as many ranges as its rows need. First occurrences are counted per
key, partially in each range before they are shuffled. What comes back for a
document is a bitmap of its lines, not text: only the 64-line words in which
a line is dropped are kept, as (word, bits), and all other lines stay.

Nulls and odd rows: a null or empty text is one empty line. A document is a row's
doc_id and text: equal rows are one document and get the same bitmap; rows of one
doc_id with different texts are different documents; null is an id like others.
Extra columns are carried along, whatever their names, unless a result has that name. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BLANKS, ascii_lower, fresh, row_hash, shuffle_width, stored

MIN_DOCS, MIN_CHARS = 10, 1
ID = ["_doc", "_row"]


def _named(docs: DataFrame) -> DataFrame:
    return docs.withColumns({"_doc": F.col("doc_id"), "_row": row_hash(F.col("doc_id"), F.col("text"))})


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_rows(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(_doc, _row, pos, h1, h2) of every line whose key has ``min_chars`` or more code points."""
    named = _named(docs.select("doc_id", "text"))
    lines = named.select(*ID, F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
    lines = lines.select(*ID, "pos", ascii_lower(F.btrim("line", F.lit(BLANKS))).alias("key")).where(F.length("key") >= min_chars)
    return lines.select(*ID, "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


def dropped_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, keep_first: bool = False) -> DataFrame:
    """(_doc, _row, bitmap) of the documents that lose lines: those of keys found in ``min_docs`` or more documents.

    bitmap is an array of (word, bits): bit i of word w is set if line 64 w + i is
    dropped. With ``keep_first``, a key's first line (least doc_id, then position)
    stays.
    """
    rows = stored(line_rows(docs, min_chars), "lines")
    dealt = rows.repartitionByRange(shuffle_width(docs.sparkSession), "h1", "h2", *ID)
    # The ranges already bring a key's rows of a document together: no further shuffle.
    in_doc = Window.partitionBy("h1", "h2", *ID).orderBy("pos")
    firsts = dealt.withColumn("nth", F.row_number().over(in_doc)).where("nth = 1")
    keys = firsts.groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.min(F.struct(*ID, "pos")).alias("first"))
    keys = keys.where(F.col("n_docs") >= min_docs)
    gone = rows.join(keys, ["h1", "h2"])
    if keep_first:
        gone = gone.where(~F.struct(*ID, "pos").eqNullSafe(F.col("first")))
    words = gone.groupBy(*ID, F.expr("cast(pos div 64 as int)").alias("word")).agg(F.expr("bit_or(shiftleft(1L, pos % 64))").alias("bits"))
    return words.groupBy(*ID).agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("bitmap"))


RESULTS = ["bitmap", "n_lines", "n_dropped", "kept"]


def with_bitmaps(docs: DataFrame, **how) -> DataFrame:
    """The rows of docs with n_lines, n_dropped, bitmap (null: all lines stay) and kept, the text of the lines that stay.

    A column of docs with the name of a result is an error.
    """
    if clash := {c.lower() for c in docs.columns} & set(RESULTS):
        raise ValueError(f"columns are named like results: {sorted(clash)}")
    doc, row, d, r, lines, words = (fresh(x, docs.columns) for x in ("_doc", "_row", "_d", "_r", "_lines", "_words"))
    bitmaps = dropped_lines(docs.select("doc_id", "text"), **how).withColumnsRenamed({"_doc": d, "_row": r})
    named = docs.withColumns({doc: F.col("doc_id"), row: row_hash(F.col("doc_id"), F.col("text"))})
    met = named.join(bitmaps, named[doc].eqNullSafe(bitmaps[d]) & (named[row] == bitmaps[r]), "left").drop(d, r, doc, row)
    met = met.withColumns({lines: _lines(F.col("text")), words: F.map_from_entries("bitmap")})
    stays = F.expr(f"filter(`{lines}`, (x, i) -> shiftright(coalesce(try_element_at(`{words}`, cast(i div 64 as int)), 0L), i % 64) & 1L = 0L)")
    return met.withColumns({
        "n_lines": F.size(lines).cast("long"),
        "n_dropped": F.coalesce(F.expr("aggregate(bitmap, 0L, (n, w) -> n + bit_count(w.bits))"), F.lit(0)).cast("long"),
        "kept": F.when(F.col("bitmap").isNull(), F.coalesce("text", F.lit(""))).otherwise(F.array_join(stays, "\n")),
    }).drop(lines, words)

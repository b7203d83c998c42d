"""Drop lines that many documents share.

Texts are cut at line feeds; a line's key is the line without ASCII white space
at its ends and with A-Z lower-cased. Lines are exploded with their position,
keys are hashed (MD5, 16 bytes) and the distinct documents of each hash are
counted. The lines whose key stands in enough documents go, in every document;
the others are reassembled by position.

What is shuffled: a hash per line and document for the counts, a hash and a
position per line for the look-up, each text once for the reassembly. The
counts combine before the shuffle. The two joins are plain equi-joins between a
fresh exchange and a written table, so adaptive execution splits the partition
of a line that stands in a third of all documents, or of a row that is repeated
as often, and broadcasts a side only after measuring it.

Edge cases: a null or empty text is one empty line; keys shorter than
``min_chars`` code points never go (with 1: empty ones); rows of one id are one
document when documents are counted, and each is answered on its own; a null id
is an id like any other; an empty table gives no rows; extra columns are
ignored, whatever their names; a text of any length stays whole.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, functions as F

from gridmart.llm.common import WS_CHARS, let, staged


def lines(text: Column) -> Column:
    """The lines of a text, empty ones and the last one too."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(WS_CHARS)), ascii_uppercase, ascii_lowercase)


def line_hash(line: Column, min_chars: int) -> Column:
    """The hash of a line's key (binary); null for a key that is too short."""
    return let(line_key(line), lambda k: F.when(F.char_length(k) >= min_chars, F.unhex(F.md5(k))))


def common_lines(docs: DataFrame, min_docs: int, min_chars: int = 1, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """``hash, n_docs`` of every key that stands in ``min_docs`` documents or more."""
    hashes = F.array_distinct(F.transform(lines(F.col(text)), lambda x: line_hash(x, min_chars)))
    found = docs.select(F.col(key).alias("id"), F.explode(hashes).alias("hash")).where(F.col("hash").isNotNull())
    return (found.distinct().groupBy("hash").agg(F.count(F.lit(1)).alias("n_docs"))
            .where(F.col("n_docs") >= min_docs))


def drop_common_lines(docs: DataFrame, min_docs: int, min_chars: int = 1, key: str = "doc_id",
                      text: str = "text") -> DataFrame:
    """``<key>, text, n_lines, n_dropped`` of every row, its common lines dropped from ``text``."""
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    # Rows of the same id and text have the same lines: one look-up answers them all.
    rows = rows.withColumn("copy", F.unhex(F.md5(F.coalesce("text", F.lit("")))))
    common = staged(common_lines(docs, min_docs, min_chars, key, text).select("hash"))
    at = F.posexplode(F.transform(lines(F.col("text")), lambda x: line_hash(x, min_chars)))
    places = rows.select("id", "copy", at.alias("pos", "hash")).where(F.col("hash").isNotNull())
    dropped = staged(places.join(common, "hash", "left_semi").groupBy("id", "copy")
                     .agg(F.collect_set("pos").alias("gone")))
    left, right = rows.alias("l"), dropped.alias("r")
    same = F.col("l.id").eqNullSafe(F.col("r.id")) & (F.col("l.copy") == F.col("r.copy"))

    def keep(ls: Column) -> Column:
        left_over = F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), F.col("gone"))
        return F.struct(F.size(ls).cast("long").alias("n"), F.when(
            F.col("gone").isNotNull(), F.array_join(F.transform(left_over, lambda i: F.get(ls, i)), "\n")).alias("kept"))

    out = left.join(right, same, "left").select("l.id", "l.text", "r.gone").select(
        "id", "text", "gone", let(lines(F.col("text")), keep).alias("o"))
    return out.select(
        F.col("id").alias(key), F.coalesce("o.kept", "text", F.lit("")).alias("text"), F.col("o.n").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"))

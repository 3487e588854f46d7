"""Line dedup: first occurrences of lines across documents, as compressed keep bitmaps.

Lines travel as hashes with their document and position, never as text. They are range-partitioned by
hash and block of documents, sorted inside each partition by document and position, and a window
streams the first document of each (hash, block). The block keeps a line that a third of all
documents hold from meeting in one task; the first occurrences of a hash in several blocks
are compared in a second, pre-aggregated step. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WHITE, free_name, lower_ascii, quoted, without
from tidemark.session import stage

#: Shorter keys are never dropped.
LEAST = 10
#: Documents with consecutive ids whose occurrences of one line meet in one window.
BLOCK = 1024


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends and with A-Z lower-cased."""
    return lower_ascii(F.btrim(line, F.lit(WHITE)))


def occurrences(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, pos and the 128-bit hash (h1, h2) of every line with a key long enough."""
    lines = docs.where(F.col("doc_id").isNotNull()).select(
        "doc_id",
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
        F.posexplode(split_lines(F.col("text"))).alias("pos", "line"),
    )
    keyed = lines.select("doc_id", "text_hash", "pos", line_key(F.col("line")).alias("key"))
    return keyed.where(F.length("key") >= LEAST).select(
        "doc_id",
        "text_hash",
        "pos",
        F.xxhash64("key").alias("h1"),
        F.xxhash64(F.lit(1), "key", F.lit("line")).alias("h2"),
    )


def dropped_lines(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, pos of the lines that an earlier document holds already.

    A key found in two documents or more keeps its lines in the one with the smallest id only. Hashes of
    128 bits stand for keys.
    """
    group = ["h1", "h2", "block"]
    dealt = (
        occurrences(docs)
        .withColumn("block", F.floor(F.col("doc_id") / BLOCK).cast("long"))
        .repartitionByRange(*group)
        .sortWithinPartitions(*group, "doc_id", "pos")
    )
    here = Window.partitionBy(*group).orderBy("doc_id", "pos")
    lines = stage(dealt.withColumn("first_here", F.first("doc_id").over(here)), "lines")
    inside = lines.where("doc_id > first_here").select("doc_id", "text_hash", "pos")
    # one row per key and block is left; keys in a single block need nothing more
    heads = lines.where("doc_id = first_here")
    first = (
        heads.groupBy("h1", "h2")
        .agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
        .where("first_id < last_id")
        .select("h1", "h2", "first_id")
    )
    across = heads.join(first, ["h1", "h2"]).where("doc_id > first_id")
    return inside.unionByName(across.select("doc_id", "text_hash", "pos"))


def drop_bitmaps(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, words: the lines to drop, as a sparse bitmap for each document with any.

    ``words`` lists (word, bits) in order: bit b of word w is set if line 64 * w + b goes. Words
    without a set bit are left out, so all lines that aren't listed are kept.
    """
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("pos") % 64).cast("int"))
    words = (
        dropped_lines(docs)
        .groupBy("doc_id", "text_hash", F.floor(F.col("pos") / 64).cast("int").alias("word"))
        .agg(F.bit_or(bit).alias("bits"))
    )
    return words.groupBy("doc_id", "text_hash").agg(
        F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("words")
    )


def _dense(words: Column) -> Column:
    """All words up to the last one that is listed, in time linear in their number."""

    def with_gap(x: Column, i: Column) -> Column:
        before = F.when(i == 0, F.lit(-1)).otherwise(F.get(words, i - 1)["word"])
        return F.concat(F.array_repeat(F.lit(0).cast("long"), x["word"] - before - 1), F.array(x["bits"]))

    return F.flatten(F.transform(words, with_gap))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` with the listed lines taken out of ``text``, plus n_lines and n_dropped.

    Columns that are called n_lines or n_dropped already are replaced.
    """
    source = without(docs, ["n_lines", "n_dropped"])
    own_id, own_hash, drop = (free_name(source, c) for c in ("marked_id", "marked_hash", "marked"))
    marks = bitmaps.select(
        F.col("doc_id").alias(own_id),
        F.col("text_hash").alias(own_hash),
        _dense(F.col("words")).alias(drop),
    )
    joined = source.join(
        marks,
        (F.col("doc_id") == F.col(own_id)) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col(own_hash)),
        "left",
    )

    def stays(_: Column, i: Column) -> Column:
        word = F.coalesce(F.get(drop, F.floor(i / 64).cast("int")), F.lit(0).cast("long"))
        return F.call_function("getbit", word, i % 64) == 0

    kept = F.array_join(F.filter(split_lines(F.col("text")), stays), "\n")
    text = F.when(F.col(drop).isNull(), F.col("text")).otherwise(kept)
    count = F.aggregate(F.transform(drop, F.bit_count), F.lit(0), lambda a, x: a + x)
    # one more than the line feeds; counting them makes no array
    feeds = F.octet_length("text") - F.octet_length(F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    return joined.select(
        *[text.alias(c) if c.lower() == "text" else F.col(f"`{c}`") for c in source.columns],
        (F.coalesce(feeds, F.lit(0)) + 1).cast("long").alias("n_lines"),
        F.coalesce(count, F.lit(0)).cast("long").alias("n_dropped"),
    )


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` without repeated lines, plus n_lines (before) and n_dropped.

    A key of at least 10 code points that two documents or more hold loses all its lines except in
    the document with the smallest id, where repeats stay as well. A null or empty text is one empty
    line. Rows without an id keep all lines and don't count as holders. Rows that repeat an id
    count as one document; each row's own text is cut. Other columns pass through.
    """
    return apply_bitmaps(docs, drop_bitmaps(docs))


def cut_repeated_lines(docs: DataFrame) -> DataFrame:
    """``dedup_lines`` with the columns of ``docs``; ``n_chars``, if there, is counted anew if lines went."""
    cut = dedup_lines(docs.select("doc_id", "text", F.struct(*[quoted(c) for c in docs.columns]).alias("row")))
    out = []
    for c in docs.columns:
        old = F.col("row").getField(c)
        if c.lower() == "text":
            old = F.col("text")
        elif c.lower() == "n_chars":
            changed = F.length("text").cast(docs.schema[c].dataType)
            old = F.when(F.col("n_dropped") > 0, changed).otherwise(old)
        out.append(old.alias(c))
    return cut.select(*out)

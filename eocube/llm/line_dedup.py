"""Line dedup: range-partitioned line hashes, first occurrences, keep bitmaps per document.

Only DataFrame functions are used. A document's lines become rows ``(hash, document,
position)``; they are range-partitioned by hash and document, so a line that a third of
all documents hold is spread over many partitions, and sorted within them by document and
position. One streaming pass over that order leaves the first row per hash and document; they
are combined, also before a shuffle, to one row per hash: in how many documents, and which
document comes first in the kept order. Lines to drop go back to their documents as
positions, which become a gap-coded bitmap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eocube.llm.tables import ascii_lower, free_name, written

BLANKS = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """The line with ASCII white space stripped at both ends and A-Z lower-cased."""
    return ascii_lower(F.trim(line, F.lit(BLANKS)))


def first_occurrences(occurs: DataFrame) -> DataFrame:
    """The first row of every hash and document; the window takes over the ranges, no group is a hash alone."""
    ordered = Window.partitionBy("h", "g", "doc_id").orderBy("pos")
    ranges = occurs.repartitionByRange("h", "g", "doc_id")
    return ranges.withColumn("nth", F.row_number().over(ordered)).where("nth = 1").drop("nth")


def dropped_lines(docs: DataFrame, *, min_chars: int = 20, min_docs: int = 3, keep: str = "last") -> DataFrame:
    """``(doc_id, pos)`` of the lines of ``(doc_id, text)`` that repeat elsewhere.

    A line counts when its key has ``min_chars`` code points and is found in
    ``min_docs`` distinct documents; it stays in the document with the largest
    (``keep="last"``) or smallest ``doc_id``, there wherever it occurs. A null
    ``doc_id`` counts as one document that comes first. Keys are compared by 96 bits
    of hashes.
    """
    lines = docs.select(
        "doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("pos", "line")
    ).select("doc_id", "pos", line_key(F.col("line")).alias("key"))
    occurs = lines.where(F.length("key") >= min_chars).select(
        F.xxhash64("key").alias("h"), F.hash("key").alias("g"), "doc_id", "pos"
    )
    # read three times: for the bounds of the ranges, for the ranges, for the lines to drop
    occurs = written(occurs, "line-hashes")
    firsts = first_occurrences(occurs)
    stays = F.max if keep == "last" else F.min
    known = F.struct(F.col("doc_id").isNotNull().alias("some"), "doc_id")
    repeated = (
        firsts.groupBy("h", "g")
        .agg(F.count("*").alias("n"), stays(known).alias("kept"))
        .where(F.col("n") >= min_docs)
        .select("h", "g", F.col("kept.doc_id").alias("kept"))
    )
    found = occurs.join(written(repeated, "repeated-lines"), ["h", "g"])
    return found.where(~F.col("doc_id").eqNullSafe(F.col("kept"))).select("doc_id", "pos")


def keep_bitmaps(docs: DataFrame, **rule) -> DataFrame:
    """``(doc_id, dropped, n_dropped)``: per document with dropped lines the gap-coded keep bitmap.

    ``dropped`` is a binary of big-endian 32-bit numbers, one per dropped line: how many
    lines are kept between the dropped line before it and itself. Documents without
    dropped lines have no row.
    """
    marks = dropped_lines(docs, **rule).distinct()
    per_doc = marks.groupBy("doc_id").agg(F.array_sort(F.collect_list("pos")).alias("at"))
    gaps = F.transform("at", lambda p, i: p - F.when(i > 0, F.col("at")[i - 1] + 1).otherwise(0))
    coded = F.unhex(F.array_join(F.transform(gaps, lambda g: F.lpad(F.hex(g), 8, "0")), ""))
    return per_doc.select("doc_id", coded.alias("dropped"), F.size("at").cast("bigint").alias("n_dropped"))


def dropped_gaps(bitmap: Column) -> Column:
    """The gaps of a coded bitmap as an array."""
    count = F.octet_length(bitmap) / 4
    places = F.sequence(F.lit(0), count.cast("int") - 1)
    return F.transform(places, lambda i: F.conv(F.hex(F.substring(bitmap, i * 4 + 1, 4)), 16, 10).cast("int"))


def kept_text(text: Column, bitmap: Column) -> Column:
    """The text without the lines its bitmap drops; the whole text where the bitmap is null."""
    lines = F.split(text, "\n", -1)
    runs = F.transform(dropped_gaps(bitmap), lambda g: F.repeat(F.lit("1"), g))
    # one character per line, '1' to keep; a binary, so that each is reached by its place
    flags = F.rpad(F.concat(F.array_join(runs, "0"), F.lit("0")), F.size(lines), "1").cast("binary")
    stay = F.filter(F.transform(lines, lambda x, i: F.when(F.substring(flags, i + 1, 1) == F.lit(b"1"), x)), F.isnotnull)
    return F.when(bitmap.isNull(), text).otherwise(F.array_join(stay, "\n"))


def drop_repeated_lines(docs: DataFrame, **rule) -> DataFrame:
    """All rows and columns of ``docs`` with repeated lines taken out of ``text``.

    A null or empty text is one empty line and stays as it is; repeated rows of one
    ``doc_id`` are one document, whose rows all keep or lose a line at a position
    together; an empty table stays empty. Texts of any length lose lines the same way.
    """
    node, bitmap = free_name(docs, "_node"), free_name(docs, "_bitmap")
    maps = keep_bitmaps(docs.select("doc_id", "text"), **rule).select(
        F.col("doc_id").alias(node), F.col("dropped").alias(bitmap)
    )
    joined = docs.join(maps, docs["doc_id"].eqNullSafe(maps[node]), "left")
    return joined.withColumn("text", kept_text(F.col("text"), F.col(bitmap))).select(*docs.columns)


def line_dedup(docs: DataFrame, **rule) -> DataFrame:
    """``(doc_id, n_lines, n_dropped, kept_sha256, keep_map)`` of every row of ``(doc_id, text)``.

    Null and empty texts, repeated rows and empty tables as in :func:`drop_repeated_lines`; texts
    and lines of any length count whole, a line by the hash of its key.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    maps = keep_bitmaps(docs, **rule).withColumnRenamed("doc_id", "_line_doc")
    joined = docs.join(maps, docs["doc_id"].eqNullSafe(maps["_line_doc"]), "left")
    return joined.select(
        "doc_id",
        F.size(F.split("text", "\n", -1)).cast("bigint").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("bigint").alias("n_dropped"),
        F.sha2(kept_text(F.col("text"), F.col("dropped")).cast("binary"), 256).alias("kept_sha256"),
        F.col("dropped").alias("keep_map"),
    )


LINE_DEDUP_SQL = """
with lines as (
  select doc_id, unnest(range(len(s))) as pos, unnest(s) as line
  from (select doc_id, string_split(coalesce(text, ''), chr(10)) as s from documents)),
keyed as (
  select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k from lines),
rep as (
  select k, max(doc_id) as kept from keyed where length(k) >= 20 group by k having count(distinct doc_id) >= 3),
marked as (
  select keyed.*, rep.k is not null and keyed.doc_id <> rep.kept as gone from keyed left join rep using (k))
select doc_id, cast(count(*) as bigint) as n_lines, cast(count(*) filter (where gone) as bigint) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from marked group by doc_id
"""

"""Exact duplicate groups by deterministic block naming, in DataFrame operations only.

A text, without its white space, is cut in blocks of a fixed size. All blocks of the
corpus are sorted, and each distinct one gets an integer name (the number of its first
occurrence). Then adjacent pairs of names are named in the same way, level by level,
until each document has one name. Equal names mean equal content at every level, so
no hash decides anything and no two different texts can share an identity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rasterloom.llm.common import documents, free_name, materialize, remove, text_of, work_dir

BLOCK = 4096
#: Blocks that occur this often are dealt over ``SALTS`` tasks; the ``HOT_BLOCKS`` most frequent are told to all tasks.
HOT_COUNT, HOT_BLOCKS, SALTS = 200, 1024, 32
SPACES = " \t\n\x0b\x0c\r"


def without_spaces(text: Column) -> Column:
    """``text`` without any character of ``[\\x20\\x09-\\x0D]``."""
    for c in SPACES:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def blocks_of(norm: Column, size: int = BLOCK) -> Column:
    """Consecutive blocks of ``size`` code points; an empty text has one empty block."""
    cut = F.regexp_extract_all(norm, F.lit("(?s).{1,%d}" % size), F.lit(0))
    return F.when(F.length(norm) <= size, F.array(norm)).otherwise(cut)


def name_blocks(df: DataFrame, id_col: str, text_col: str, size: int, rid_col: str | None = None) -> DataFrame:
    """One row for each block: ``rid, i, n, o, name`` and, on a document's first block, ``doc_id, n_cp, sha``."""
    text = text_of(df, text_col)
    rid = df[rid_col] if rid_col else F.monotonically_increasing_id()
    norm = df.select(rid.alias("rid"), df[id_col].alias("doc_id"), F.length(text).alias("n_cp"), without_spaces(text).alias("norm"))
    cut = norm.select("rid", "doc_id", "n_cp", F.sha2(F.col("norm").cast("binary"), 256).alias("sha"), blocks_of(F.col("norm"), size).alias("blocks"))
    rows = cut.select("rid", "doc_id", "n_cp", "sha", F.size("blocks").alias("n"), F.posexplode("blocks").alias("i", "block"))
    hot = norm.select(F.explode(blocks_of(F.col("norm"), size)).alias("block")).groupBy(F.xxhash64("block").alias("h")).count()
    hot = hot.where(F.col("count") >= HOT_COUNT).orderBy(F.desc("count"), "h").limit(HOT_BLOCKS).select("h", F.lit(True).alias("hot"))
    first = F.col("i") == 0
    rows = rows.select("rid", "i", "n", "block", F.monotonically_increasing_id().alias("o"), F.xxhash64("block").alias("h"), *(F.when(first, F.col(c)).alias(c) for c in ("doc_id", "n_cp", "sha")))
    rows = rows.join(F.broadcast(hot), "h", "left").withColumn("salt", F.when(F.col("hot"), F.pmod("o", F.lit(SALTS))).otherwise(F.lit(0)))
    rows = rows.withColumn("name", F.min("o").over(Window.partitionBy("salt", "block")))
    rows = rows.withColumn("block", F.when(F.col("hot") & (F.col("o") == F.col("name")), F.col("block")))
    rows = materialize(rows.select("rid", "i", "n", "o", "name", "block", "doc_id", "n_cp", "sha"))
    # A hot block has a name for each salt by now; those few, bounded by SALTS * HOT_BLOCKS, become one.
    one = rows.where("block IS NOT NULL").select(F.col("name"), F.min("name").over(Window.partitionBy("block")).alias("one"))
    return rows.drop("block").join(F.broadcast(one), "name", "left").withColumn("name", F.coalesce("one", "name")).drop("one")


def name_pairs(segments: DataFrame, path: str) -> DataFrame:
    """One level up, written to ``path``: ``rid, i, o, name`` for each pair of neighbours; a last one without a neighbour is paired with -1."""
    spark = segments.sparkSession
    pairs_path, names_path = work_dir(spark), work_dir(spark)
    even = F.col("i") % 2 == 0
    pairs = segments.groupBy("rid", F.floor(F.col("i") / 2).alias("i")).agg(
        F.min("o").alias("o"), F.max(F.when(even, F.col("name"))).alias("l"), F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("r")
    )
    pairs = materialize(pairs, pairs_path)
    names = materialize(pairs.groupBy("l", "r").agg(F.min("o").alias("name")), names_path)
    out = materialize(pairs.join(names, ["l", "r"]).select("rid", "i", "o", "name"), path)
    remove(spark, pairs_path)
    remove(spark, names_path)
    return out


def identities(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = BLOCK, rid_col: str | None = None) -> DataFrame:
    """``rid, doc_id, n_cp, sha, n, name``: rows have equal ``(n, name)`` if and only if their texts are equal without white space.

    ``rid`` numbers the rows; it is ``rid_col`` if there is one.
    """
    rows = name_blocks(df, id_col, text_col, size, rid_col)
    firsts = rows.where("i = 0").select("rid", "doc_id", "n_cp", "sha", "n", "name")
    top = rows.agg(F.max("n")).first()[0] or 0
    if top < 2:
        return firsts
    level, width = rows.where("n > 1").select("rid", "i", "o", "name"), top
    before = None
    while width > 1:
        path = work_dir(df.sparkSession)
        level, width = name_pairs(level, path), (width + 1) // 2
        if before:
            remove(df.sparkSession, before)
        before = path
    whole = level.select("rid", F.col("name").alias("whole"))
    out = materialize(firsts.join(whole, "rid", "left").withColumn("name", F.coalesce("whole", "name")).drop("whole"))
    remove(df.sparkSession, before)
    return out


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = BLOCK, rid_col: str | None = None) -> DataFrame:
    """``rid, doc_id, keep_id, group_size, kept, text_sha256`` for each row.

    Of equal texts the row with the most code points in its original text stays, then
    that of the smallest id (a null id counts as the largest), then the first row: of
    rows repeated in full exactly one stays. Null texts count as empty, and empty texts
    are equal to each other. An empty table gives an empty table.
    """
    docs = identities(df, id_col, text_col, size, rid_col)
    best = F.min(F.struct((-F.col("n_cp")).alias("x"), F.col("doc_id").isNull().alias("z"), "doc_id", "rid"))
    groups = materialize(docs.groupBy("n", "name").agg(best.alias("best"), F.count("*").alias("group_size")))
    return docs.join(groups, ["n", "name"]).select("rid", "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("rid") == F.col("best.rid")).alias("kept"), F.col("sha").alias("text_sha256"))


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows are numbered in a written table: numbers made anew by a second scan could differ,
    as splits follow the number of executors.
    """
    rid = free_name(docs, "__rid")
    rows = materialize(docs.withColumn(rid, F.monotonically_increasing_id()))
    kept = exact_groups(rows, id_col, text_col, rid_col=rid).where("kept").select(F.col("rid").alias(rid))
    return rows.join(kept, rid, "left_semi").drop(rid)


def op10_block_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact groups of the whole ``documents`` table."""
    return exact_groups(documents(spark, sf_dir)).drop("rid")


OP10_SQL = """
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS k FROM documents
)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY k) AS group_size,
       row_number() OVER w = 1 AS kept, sha256(k) AS text_sha256
FROM d WINDOW w AS (PARTITION BY k ORDER BY n DESC, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
"""

"""What the operators of this subpackage share: text handling, id buckets and word splitting."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom.session import materialize, remove, ship_package, work_dir

__all__ = ["bucket", "documents", "first_by_hash", "free_name", "materialize", "packed_words", "remove", "ship_package", "text_of", "words_of", "work_dir"]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole ``documents`` table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(df: DataFrame, text_col: str = "text") -> Column:
    """The text column, null counting as empty."""
    return F.coalesce(df[text_col], F.lit(""))


def bucket(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def first_by_hash(df: DataFrame, n: int, id_col: str, *more: str) -> DataFrame:
    """The ``n`` rows of the least hash of an id, ties by the id and ``more``.

    Rows far beyond that rank are filtered out first, by a bound that the count of rows
    gives, so that tasks don't each send ``n`` rows to one place.
    """
    total = max(df.count(), 1)
    h = F.xxhash64(id_col)
    bound = int(min(1.0, (2 * n + 1000) / total) * (1 << 40))
    return df.where(F.pmod(h, F.lit(1 << 40)) < bound).orderBy(F.pmod(h, F.lit(1 << 40)), id_col, *more).limit(n)


def words_of(text: str | None) -> list[bytes]:
    """ASCII-lower-cased words of a text, split at ``[\\x20\\x09-\\x0D]``, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def packed_words(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All words of some texts packed together; where each begins; how many each text has."""
    b = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    inside = ~_SPACE[b]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    begin, end = np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]
    size = end - begin
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    counts = np.bincount(np.searchsorted(text_ends, begin, "right"), minlength=len(texts)) if len(begin) else np.zeros(len(texts), np.int64)
    return b[inside].tobytes(), np.cumsum(size) - size, counts

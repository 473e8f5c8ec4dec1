"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than space and the five ASCII controls from tab on.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else; whole-string `lower` where all characters are ASCII."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


#: Bytes to fold a text in UTF-8: A-Z to a-z, digits and what is not ASCII as they are, all else to blanks.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or b >= 97 and not 123 <= b <= 127 else 32 for b in range(256))
#: A longer text is split into words piece by piece.
RUN_BYTES = 4_000_000


def folded_runs(text: bytes, carry: int, size: int = RUN_BYTES) -> Iterator[tuple[int, int, list[bytes]]]:
    """(number of the first word, repeated words, words) of a text in pieces of `size` bytes and a word.

    Words are runs of digits, letters and what is not ASCII, with A-Z lower-cased. Each piece repeats the last `carry` words
    before it, so no run of `carry + 1` words is cut.
    """
    data, start, done, before = text.translate(FOLD), 0, 0, []
    while start < len(data):
        end = data.find(b" ", start + size) if start + size < len(data) else -1
        end = len(data) if end < 0 else end
        words = before + data[start:end].split()
        if len(words) > len(before):
            yield done - len(before), len(before), words
            done += len(words) - len(before)
            before = words[-carry:] if carry else []
        start = end


def give_back() -> None:
    """Return freed memory to the system, Arrow's too: a Python worker outlives its stage, and later ones need the room."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))

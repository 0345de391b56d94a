"""Small helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rasterloom.session import scratch_dir


def stored(df, name="llm"):
    """Write a table once to the shared folder and read it back.

    Later jobs re-read it instead of re-running what made it, on whatever executors are left, and
    ids made by ``monotonically_increasing_id`` are fixed from there on.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(docs, *columns):
    """The named columns and a row number ``uid``; store the result before using it twice."""
    return docs.select(F.monotonically_increasing_id().alias("uid"), *columns)


def schema(docs, columns, more):
    """A result schema: ``columns`` as they are in ``docs``, then those of the DDL string ``more``."""
    return T.StructType([docs.schema[c] for c in columns] + T.StructType.fromDDL(more).fields)


def folded(docs):
    """doc_id, text, and all other columns in one column ``rest``, so that no name can clash."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(*(F.col(f"`{c}`") for c in others), F.lit(0).alias("")).alias("rest"))


def unfolded(rows, columns):
    """The columns that ``folded`` put away, in their old order."""
    return rows.select(*(F.col(c) if c in ("doc_id", "text") else F.col("rest").getField(c).alias(c) for c in columns))


def shuffled(df):
    """The right side of a join that broadcasts neither side, for tables that grow with the corpus.

    Spark takes rows that a table unfolds, by explode or mapInArrow, for as small as the stored table, and stored
    tables of repeated values for as small as their files; a broadcast of either goes through the driver whole.
    """
    return df.hint("merge")


def spread_join(left, right, keys):
    """Inner join on integer keys, in which a hot key of ``left`` can be split.

    A table that was grouped by the keys lies partitioned by them, and a join on them would take it as
    it lies; then adaptive execution may not split a hot partition. Joined on the complements of the
    keys, both sides get an exchange of their own.
    """
    names = [f"_{k}" for k in keys]
    right = right.select(*(F.bitwise_not(F.col(k)).alias(n) for k, n in zip(keys, names)), *(c for c in right.columns if c not in keys))
    return left.withColumns({n: F.bitwise_not(F.col(k)) for k, n in zip(keys, names)}).join(right, names).drop(*names)


class Seen:
    """Remembers up to ``limit`` values of one task, to send repeated rows once. Forgetting costs rows, not results."""

    def __init__(self, limit=1 << 20):
        self.limit, self.values = limit, set()

    def add(self, value):
        """Is the value new?"""
        if value in self.values:
            return False
        if len(self.values) >= self.limit:
            self.values.clear()
        self.values.add(value)
        return True

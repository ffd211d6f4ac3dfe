"""Vector code compression: product codes learnt by Lloyd rounds in which parts stay with their entry.

Every kept vector becomes integers ``floor(4096 * x)`` and is cut into ``parts`` consecutive pieces. A
piece belongs to one entry of its position's codebook; the table of pieces is laid out by (position,
entry, salt), so each owner -- an entry of a codebook -- finds its members resident in a few tasks and
updates itself from their partial sums. A round assigns every piece anew against the small codebook
(broadcast with its proven size ``parts x entries x width``); a piece that keeps its entry stays where it
is, and only pieces that change entry go through the next exchange. The salt splits an entry that holds
many pieces (a hot vector shared by a third of all rows lands in as many tasks as there are salts).

Defined results:

* Rows whose vector is null, empty, or holds a null or non-finite component are dropped; so are rows whose
  vector length differs from that of the first codebook row (the smallest kept ``vec_id``), as pieces of
  other lengths have no entry to compare with. Null ``vec_id`` rows sort after all others.
* Fewer kept rows than ``entries``: the codebooks have as many entries as there are kept rows.
* Repeated rows are members like any other; equal ``vec_id`` are ordered by their vectors to pick the first
  codebook.
* Ties of distance go to the lower entry. An entry without members keeps its values.
* An empty table gives no rows (and the codebooks' digest of an empty list).
* Integers are 64-bit; components beyond ``+-2**31 / 4096`` may overflow squared distances.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import free_name
from shelfcast.session import fresh_path, remove_at_end

#: Scale of the integer grid.
GRID = 4096


def integer_vectors(df: DataFrame, vector: str, out: str) -> DataFrame:
    """Rows whose vector is whole and finite, with ``out`` = its components as ``floor(4096 * x)``."""
    x = F.col(f"`{vector}`")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
    return df.where(x.isNotNull() & (F.size(x) > 0) & finite).withColumn(
        out, F.transform(x, lambda v: F.floor(v.cast("double") * GRID).cast("long"))
    )


def cuts(width: int, parts: int) -> list[tuple[int, int]]:
    """Start and length of every part: consecutive, as equal as the width allows."""
    bounds = [width * p // parts for p in range(parts + 1)]
    return [(bounds[p], bounds[p + 1] - bounds[p]) for p in range(parts)]


def squared(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda u, v: (u - v) * (u - v)), F.lit(0).cast("long"), lambda s, d: s + d)


def nearest(piece: Column, book: Column) -> tuple[Column, Column]:
    """Index of the nearest entry of ``book`` (ties to the lower index) and its squared distance."""
    distances = F.transform(book, lambda entry: squared(entry, piece))
    least = F.array_min(distances)
    return (F.array_position(distances, least) - 1).cast("int"), least


def book_frame(spark, books: list[list[list[int]]]) -> DataFrame:
    return spark.createDataFrame(
        [(p, b) for p, b in enumerate(books)], "pos int, book array<array<long>>"
    )


def learn_codes(
    df: DataFrame,
    vector: str = "embedding",
    id_column: str = "vec_id",
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    salts: int | None = None,
) -> tuple[DataFrame, list[list[list[int]]]]:
    """Fit the codebooks by ``rounds`` Lloyd rounds; returns the kept rows with ``_code`` (entry of every
    part, in part order) and ``_error`` (squared distances summed), and the final codebooks."""
    spark = df.sparkSession
    ints = free_name(df, "_ints")
    kept = integer_vectors(df, vector, ints)
    first = kept.orderBy(F.col(f"`{id_column}`").asc_nulls_last(), F.col(ints)).limit(entries).select(ints).collect()
    if not first:
        return _coded(kept, ints, [], []), []
    width = len(first[0][0])
    kept = kept.where(F.size(ints) == width)
    layout = cuts(width, parts)
    books = [[row[0][s : s + n] for row in first] for s, n in layout]
    salts = salts or int(spark.conf.get("spark.sql.shuffle.partitions"))

    # The table of pieces, stored once: (position, piece), salted by the row.
    pieces = kept.select(
        F.xxhash64(F.col(f"`{id_column}`"), F.col(ints)).alias("row"),
        F.posexplode(F.array(*[F.slice(ints, s + 1, n) for s, n in layout])).alias("pos", "piece"),
    ).withColumn("salt", F.pmod(F.col("row"), F.lit(salts)).cast("int"))
    resident = _store(pieces.withColumn("entry", F.lit(-1)), "pieces")
    for _ in range(rounds):
        placed = resident.join(F.broadcast(book_frame(spark, books)), "pos").withColumn(
            "next", nearest(F.col("piece"), F.col("book"))[0]
        ).drop("book")
        stay = placed.where(F.col("next") == F.col("entry"))
        move = placed.where(F.col("next") != F.col("entry")).repartition("pos", "next", "salt")
        resident = _store(
            stay.unionByName(move).select("row", "pos", "piece", "salt", F.col("next").alias("entry")), "pieces"
        )
        books = _update(resident, books, layout)
    return _coded(kept, ints, books, layout), books


def _store(df: DataFrame, label: str) -> DataFrame:
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    remove_at_end(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _update(resident: DataFrame, books, layout) -> list[list[list[int]]]:
    """Every owner's new values: componentwise floor of the mean of its members; partial sums per salt
    first, so a hot entry is summed in as many tasks as it has salts."""
    longest = max(n for _, n in layout)
    partial = resident.groupBy("pos", "entry", "salt").agg(
        F.count(F.lit(1)).alias("members"),
        *[F.sum(F.get(F.col("piece"), i).cast("decimal(38,0)")).alias(f"s{i}") for i in range(longest)],
    )
    owners = partial.groupBy("pos", "entry").agg(
        F.sum("members").alias("members"), *[F.sum(f"s{i}").alias(f"s{i}") for i in range(longest)]
    )
    fresh = [[list(entry) for entry in book] for book in books]
    for row in owners.collect():  # at most parts x entries rows
        n = row["members"]
        fresh[row["pos"]][row["entry"]] = [int(row[f"s{i}"]) // n for i in range(layout[row["pos"]][1])]
    return fresh


def _coded(kept: DataFrame, ints: str, books, layout) -> DataFrame:
    """Final assignment of every kept row, map-side against all codebooks."""
    if not books:
        return kept.withColumn("_code", F.array().cast("array<int>")).withColumn(
            "_error", F.lit(None).cast("long")
        ).drop(ints).limit(0)
    found = [
        nearest(F.slice(F.col(ints), s + 1, n), F.lit(book).cast("array<array<long>>"))
        for (s, n), book in zip(layout, books, strict=True)
    ]
    error = found[0][1]
    for _, d in found[1:]:
        error = error + d
    return kept.select(
        "*", F.array(*[i for i, _ in found]).alias("_code"), error.alias("_error")
    ).drop(ints)


def books_digest(books: list[list[list[int]]]) -> str:
    """sha256 of all entries' components by part, entry, place, ``,``-joined, in lowercase hex."""
    text = ",".join(str(v) for book in books for entry in book for v in entry)
    return hashlib.sha256(text.encode()).hexdigest()


def compress(
    df: DataFrame,
    vector: str = "embedding",
    id_column: str = "vec_id",
    label: str = "label",
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every kept row.

    ``code`` is the hexadecimal of every part's entry, two digits each; ``label_error`` sums ``error`` over
    rows of an equal label, nulls together (a partial aggregate joined back, not a window over a label).
    """
    coded, books = learn_codes(df.select(id_column, vector, label), vector, id_column, parts, entries, rounds)
    code = F.concat_ws("", F.transform(F.col("_code"), lambda i: F.lpad(F.lower(F.hex(i)), 2, "0")))
    rows = coded.select(
        F.col(f"`{id_column}`").alias("vec_id"), code.alias("code"), F.col("_error").alias("error"),
        F.col(f"`{label}`").alias("_label"),
    )
    sums = rows.groupBy("_label").agg(F.sum("error").alias("label_error")).withColumnRenamed("_label", "_same")
    return rows.join(sums, rows["_label"].eqNullSafe(sums["_same"])).select(
        "vec_id", "code", "error", F.col("label_error").cast("long"), F.lit(books_digest(books)).alias("codebooks_sha256")
    )

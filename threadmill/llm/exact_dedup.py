"""Exact duplicates by naming blocks: equal blocks share an integer name, then equal pairs of names do, until a document is one name."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import discard, stored, unused

#: Bytes of a block.
BLOCK = 8192
#: What texts are freed of before they are compared.
BLANKS = r"[\x20\x09-\x0D]"
_LAST = 2**63 - 1


def _named(keys: DataFrame, *cols: str) -> DataFrame:
    """Distinct keys with integer names: their ranks in sorted order within a partition, numbered on from partition to partition.

    Partitions are dealt by the key's hash and then sorted, so a task that runs again gives the same names."""
    return stored(keys.select(*cols).distinct().sortWithinPartitions(*cols).withColumn("name", F.monotonically_increasing_id()), "names")


def _first_names(blocks: DataFrame) -> DataFrame:
    """hash, name for each distinct block, or hash, block, name where blocks of one hash differ.

    The contents are compared: per hash the least and the greatest block. As good as always they are one, and the hash stands for
    it from here on, so contents are shuffled once, after equal ones of a task have met."""
    per_hash = blocks.groupBy("hash").agg(F.min("block").alias("least"), F.max("block").alias("most")).sortWithinPartitions("hash")
    return stored(per_hash.select("hash", (F.col("least") != F.col("most")).alias("clash"), F.monotonically_increasing_id().alias("name")), "blocks")


def identities(docs: DataFrame, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text", hashed=F.xxhash64, row_col: str | None = None) -> DataFrame:
    """One row for each row of docs: row (row_col, or a number of its own), doc_id, n_chars, sha256 (of the text without BLANKS), levels, name.

    Two texts without BLANKS are equal if and only if levels and name are. Names are integers; hashes only deal rows out and
    stand for contents once those have been compared (hashed is a parameter so that tests can make it clash)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select((F.col(row_col) if row_col else F.monotonically_increasing_id()).alias("row"), F.col(id_col).alias("doc_id"), F.length(text).cast("long").alias("n_chars"), F.regexp_replace(text, BLANKS + "+", "").alias("norm"))
    data = F.col("norm").cast("binary")
    base = base.select("row", "doc_id", "n_chars", F.unhex(F.sha2(data, 256)).alias("sha256"), data.alias("data"), F.greatest(F.lit(1), F.ceil(F.octet_length(data) / block)).cast("int").alias("n"))
    cut = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda k: F.substring(F.col("data"), k * block + 1, F.lit(block)))
    blocks = base.select("row", "doc_id", "n_chars", "sha256", "n", F.posexplode(cut).alias("k", "block")).withColumn("hash", hashed("block"))
    # The document's own columns go with its first block.
    own = [F.when(F.col("k") == 0, F.col(c)).alias(c) for c in ("doc_id", "n_chars", "sha256")]
    names = _first_names(blocks.select("hash", "block"))
    if names.filter("clash").limit(1).count():
        # Read twice below: numbered once.
        blocks = stored(blocks, "clashing")
        exact = _named(blocks.join(names.filter("clash").select("hash"), "hash", "left_semi"), "hash", "block")
        clear = blocks.join(names.filter("not clash").select("hash", "name"), "hash")
        offset = names.agg(F.max("name")).first()[0] + 1
        clashing = blocks.join(exact.withColumn("name", F.col("name") + offset), ["hash", "block"])
        level = clear.select("row", *own, "n", "k", "name").unionByName(clashing.select("row", *own, "n", "k", "name"))
    else:
        level = blocks.select("row", *own, "n", "k", "hash").join(names.select("hash", "name"), "hash").drop("hash")
    level = stored(level, "level")
    discard(names)
    done, depth = [level.filter("n = 1").withColumn("levels", F.lit(0))], 0
    left = level.filter("n > 1")
    while left.limit(1).count():
        depth += 1
        first = F.max(F.when(F.col("k") % 2 == 0, F.col("name")))
        second = F.coalesce(F.max(F.when(F.col("k") % 2 == 1, F.col("name"))), F.lit(-1))
        pairs = left.groupBy("row", F.floor(F.col("k") / 2).cast("int").alias("half")).agg(*[F.max(c).alias(c) for c in ("doc_id", "n_chars", "sha256")], F.max("n").alias("n"), first.alias("a"), second.alias("b"))
        pairs = stored(pairs.withColumn("n", F.ceil(F.col("n") / 2).cast("int")).withColumnRenamed("half", "k"), "pairs")
        names = _named(pairs, "a", "b")
        level = stored(pairs.join(names, ["a", "b"]).drop("a", "b"), "level")
        discard(names)
        discard(pairs)
        done.append(level.filter("n = 1").withColumn("levels", F.lit(depth)))
        left = level.filter("n > 1")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.select("row", "doc_id", "n_chars", "sha256", "levels", "name")


def classes(docs: DataFrame, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text", hashed=F.xxhash64, row_col: str | None = None) -> DataFrame:
    """One row for each row of docs: doc_id, keep_id, group_size, kept, text_sha256, and row (row_col, or a number made here that
    no other read of docs repeats for sure).

    Texts are equal if they are so without BLANKS; of equal ones the row with the most code points stays, then the smallest
    doc_id. A null text counts as empty, and empty ones are equal. A null id counts as the largest. Of rows that agree in id and
    length just one is kept. An empty table gives no rows; no other column is read. Groups of any size are counted by tasks
    before they meet, and joined back row by row."""
    known = identities(docs, block, id_col, text_col, hashed, row_col)
    best = F.min(F.struct((-F.col("n_chars")).alias("shorter"), F.coalesce("doc_id", F.lit(_LAST)).alias("by"), "row", "doc_id"))
    groups = stored(known.groupBy("levels", "name").agg(best.alias("best"), F.count("*").alias("group_size")), "groups")
    return known.join(groups, ["levels", "name"]).select(
        known["doc_id"],
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("best.row") == known["row"]).alias("kept"),
        F.lower(F.hex("sha256")).alias("text_sha256"),
        known["row"],
    )


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows that classes() doesn't keep; all columns stay, whatever their names, and the values of kept rows.

    Null texts count as empty, and of rows without any text one stays; of equal rows one stays; an empty table gives no rows.

    docs is stored once with its row numbers, for classes() and for the join: another scan may pack files differently."""
    row = unused("_row", docs.columns)
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    kept = classes(numbered, id_col=id_col, text_col=text_col, row_col=row).filter("kept").select(F.col("row").alias(row))
    return numbered.join(kept, row, "left_semi").select(*docs.columns)

"""Drop lines that many documents share, keeping the first holder's copy.

Lines are exploded, their normalised form hashed to 128 bits, distinct documents
counted per hash, and the line numbers to drop joined back to the documents, which
are put together again by position. Counting combines before each shuffle. Both joins
read their counted side from a stored table: adaptive execution splits a crowded key
only between plain shuffles, not above an aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from chamberlens.llm.common import BLANKS, ascii_lower, free_names, without
from chamberlens.session import stored


def line_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 10,
    min_docs: int = 2,
) -> DataFrame:
    """The documents with shared lines removed, plus ``n_lines`` and ``n_dropped``.

    A line's key is the line without blanks at both ends, A-Z in lower case. Lines whose
    key has at least ``min_chars`` code points and occurs in at least ``min_docs``
    documents stay only in the document of the smallest id; there, repetitions stay too.

    Null or empty text is one empty line and comes back empty. A row without id neither
    counts nor loses lines. Rows that share an id are one document: they count once, and
    all of them keep or lose a line alike. Other columns are carried along; input
    columns named ``n_lines`` or ``n_dropped`` are replaced. Runs jobs when called: the
    shared lines' hashes and the line numbers to drop are checkpointed.
    """
    base = without(docs, "n_lines", "n_dropped")
    lines, mark, gone, id_of, mark_of = free_names(base, "_lines", "_mark", "_gone", "_id_of", "_mark_of")
    text = F.coalesce(F.col(text_col), F.lit(""))
    marked = base.withColumns({mark: F.xxhash64(text), lines: F.split(text, "\n", -1)})

    exploded = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.xxhash64(text).alias("mark"), F.posexplode(F.split(text, "\n", -1)).alias("pos", "line")
    )
    key = ascii_lower(F.btrim(F.col("line"), F.lit(BLANKS)))
    keyed = (
        exploded.select("id", "mark", "pos", key.alias("key"))
        .where(F.char_length("key") >= min_chars)
        .select("id", "mark", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))
    )
    shared = stored(
        keyed.groupBy("h1", "h2")
        .agg(F.count_distinct("id").alias("n"), F.min("id").alias("first"))
        .where(F.col("n") >= min_docs)
        .select("h1", "h2", "first")
    )
    drops = stored(
        keyed.join(shared, ["h1", "h2"])
        .where(F.col("id") != F.col("first"))
        .groupBy(F.col("id").alias(id_of), F.col("mark").alias(mark_of))
        .agg(F.collect_set("pos").alias(gone))
    )
    joined = marked.join(drops, (F.col(id_col) == F.col(id_of)) & (F.col(mark) == F.col(mark_of)), "left")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    rest = F.array_join(F.transform(kept, lambda p: F.get(F.col(lines), p)), "\n")
    result = joined.withColumns(
        {
            text_col: F.when(F.col(gone).isNull(), F.array_join(lines, "\n")).otherwise(rest),
            "n_lines": F.size(lines).cast("bigint"),
            "n_dropped": F.coalesce(F.size(gone), F.lit(0)).cast("bigint"),
        }
    )
    return result.select(*base.columns, "n_lines", "n_dropped")

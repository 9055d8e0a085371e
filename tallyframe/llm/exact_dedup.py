"""Exact dedup: tree-merge of digest runs.

Every row becomes a digest (SHA-256 of the text) with two witnesses (length in bytes, a 64-bit hash of another kind). The rows of a
run are first reduced to one entry per digest; then runs meet in rounds of ``fan`` partners, as in a binomial tree, and each round
merges the partners' entries: sizes add up, the identifier that stays is kept. An entry merges with another only if digest and
witnesses agree. After ``log_fan(runs)`` rounds one logical run is left, spread over the cluster by digest. A group of copies of any
size is one entry per run after the first step, so no task ever gets the copies of a hot group in a later round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.shared import free_name, picked, written

ENTRY = ["digest", "n_bytes", "witness"]


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", runs: int = 16) -> DataFrame:
    """One row per document, null text as empty: its digest, witnesses, a row number ``rid`` and its run. Written, so that row numbers stay."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = picked(docs, doc_id=id_col, text=text_col).select("doc_id", F.monotonically_increasing_id().alias("rid"), F.unhex(F.sha2(text, 256)).alias("digest"),
                                                             F.octet_length(text).alias("n_bytes"), F.xxhash64(text).alias("witness"))
    return written(rows.withColumn("run", F.pmod(F.xxhash64("rid"), F.lit(runs)).cast("int")), "digests")


def merge(entries: DataFrame, best) -> DataFrame:
    """One round: the entries of a run that agree in digest and witnesses become one."""
    return entries.groupBy("run", *ENTRY).agg(best("stays").alias("stays"), F.sum("n").alias("n"))


def tree_merge(rows: DataFrame, runs: int = 16, fan: int = 4, keep: str = "largest") -> DataFrame:
    """(digest, n_bytes, witness, stays {doc_id, rid}, n): for every distinct text the row that stays and the number of rows.

    ``keep`` is ``largest`` or ``smallest`` identifier; a null identifier counts as the smallest one, and rows that share an
    identifier are told apart by row number.
    """
    best = {"largest": F.max, "smallest": F.min}[keep]
    entries = merge(rows.select("run", *ENTRY, F.struct("doc_id", "rid").alias("stays"), F.lit(1).cast("long").alias("n")), best)
    left = runs
    while left > 1:
        left = -(-left // fan)
        entries = merge(entries.withColumn("run", F.floor(F.col("run") / fan).cast("int")), best)
    return entries.drop("run")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", runs: int = 16, fan: int = 4, keep: str = "largest") -> DataFrame:
    """Every row of ``docs`` with the row that stays for its text.

    Result: doc_id, keep_id, group_size, kept, text_sha256, one row per input row. Null text counts as empty; an empty table gives an
    empty result; of rows repeated with the same identifier and text exactly one is kept; other columns are ignored.
    """
    rows = digests(docs, id_col, text_col, runs)
    groups = tree_merge(rows, runs, fan, keep)
    joined = rows.select("doc_id", "rid", *ENTRY).join(groups, ENTRY)
    return joined.select("doc_id", F.col("stays.doc_id").alias("keep_id"), F.col("n").alias("group_size"), (F.col("rid") == F.col("stays.rid")).alias("kept"),
                         F.lower(F.hex("digest")).alias("text_sha256"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, whatever their names; a row repeated with its identifier and text stays once. Null text counts
    as empty, a null identifier as the smallest; an empty table stays empty.

    The texts are shuffled once: the semi-join and the removal of repeated rows share one key.
    """
    def key(identifier, digest):
        return F.concat(F.coalesce(F.col(identifier).cast("string"), F.lit("-")), F.lit(":"), digest)

    row = free_name(docs.columns, "row_key")
    stay = exact_dedup(docs, id_col, text_col, **options).where("kept").select(key("doc_id", F.col("text_sha256")).alias(row))
    marked = docs.withColumn(row, key(f"`{id_col}`", F.sha2(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), 256)))
    return marked.join(stay, row, "left_semi").dropDuplicates([row]).select(*[F.col(f"`{c}`") for c in docs.columns])

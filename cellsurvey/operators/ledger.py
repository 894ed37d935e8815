"""Work ledgers, set operations on ids, merging of tables, and stable buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellsurvey.functions.text import id_modulo


def list_difference(left: DataFrame, right: DataFrame, key: str = "id") -> DataFrame:
    """Distinct ids of ``left`` that ``right`` does not hold."""
    return left.select(key).distinct().join(right.select(key), key, "left_anti")


def list_union(*lists: DataFrame, key: str = "id") -> DataFrame:
    """Distinct ids of all lists."""
    out = lists[0].select(key)
    for other in lists[1:]:
        out = out.unionByName(other.select(key))
    return out.distinct()


def list_intersection(left: DataFrame, right: DataFrame, key: str = "id") -> DataFrame:
    return left.select(key).distinct().join(right.select(key), key, "left_semi")


def outstanding(todo: Sequence[DataFrame], done: DataFrame, key: str = "id") -> DataFrame:
    """Work set of a stage: ids of any to-do list that are not done."""
    return list_difference(list_union(*todo, key=key), done, key)


def outstanding_for_shard(todo: Sequence[DataFrame], done: DataFrame, divisor: int, shard: int, key: str = "id") -> DataFrame:
    """Work set limited to the ids of one stable bucket."""
    return outstanding(todo, done, key).filter(id_modulo(F.col(key), divisor) == shard)


def with_bucket(ids: DataFrame, divisor: int, key: str = "id") -> DataFrame:
    """The stable bucket of every id: the same on every run and machine."""
    return ids.withColumn("bucket", id_modulo(F.col(key), divisor))


def retry_first(failed: DataFrame, found: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """Failed and newly found ids that are not done, failed ones marked to go first."""
    marked = failed.select(key, F.lit(0).alias("priority")).unionByName(found.select(key, F.lit(1).alias("priority")))
    return marked.groupBy(key).agg(F.min("priority").alias("priority")).join(done.select(key), key, "left_anti")


def recent(df: DataFrame, column: str, until: Column, days: int) -> DataFrame:
    """Rows of the last ``days`` days before ``until``."""
    return df.filter(F.col(column) >= until - F.make_interval(days=F.lit(days)))


def stage_outcome(status: DataFrame) -> DataFrame:
    """Per project from its runs' ``ok`` flags: all good -> done, some -> partial, none -> neither; always seen."""
    flags = status.groupBy("proj_id").agg(F.bool_and("ok").alias("all_ok"), F.bool_or("ok").alias("any_ok"))
    return flags.select(
        "proj_id",
        F.when(F.col("all_ok"), F.col("proj_id")).alias("done"),
        F.when(F.col("any_ok") & ~F.col("all_ok"), F.col("proj_id")).alias("partial"),
        F.col("proj_id").alias("seen"),
    )


def ledger_after(ledger: DataFrame, outcome: DataFrame) -> DataFrame:
    """Ledger (id, state) joined with the new done/partial/seen ids, each once."""
    new = outcome.select(F.explode(F.array_compact(F.array(*[
        F.when(F.col(s).isNotNull(), F.struct(F.col(s).cast("string").alias("id"), F.lit(s).alias("state")))
        for s in ("done", "partial", "seen")
    ]))).alias("e")).select("e.id", "e.state")
    return ledger.select("id", "state").unionByName(new).distinct()


def merge_rows(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Both tables under each other, missing text columns '', exact duplicates removed."""
    merged = existing.unionByName(new, allowMissingColumns=True)
    text = [f.name for f in merged.schema.fields if f.dataType.simpleString() == "string"]
    return merged.na.fill("", text).dropDuplicates()


def first_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the first in ``order``; an aggregate, so hot keys merge map side."""
    rest = [c for c in df.columns if c not in keys]
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    row = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], F.struct(*rest).alias("r"))
    return df.groupBy(*keys).agg(F.min(row).alias("m")).select(*keys, "m.r.*")


def distinct_terms(membership: DataFrame) -> DataFrame:
    """(proj_id, term, node) without terms whose member set equals that of an earlier-named term.

    Member sets are compared by order-free digests; terms that share a digest are then compared
    member by member, so a digest clash never drops a term. No member set is ever collected.
    """
    m = membership.select("proj_id", "term", "node").distinct()
    signature = m.groupBy("proj_id", "term").agg(
        F.count(F.lit(1)).alias("size"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("s1"),
        F.bit_xor(F.xxhash64("node", F.lit(7))).alias("s2"),
    )
    alike = ["proj_id", "size", "s1", "s2"]
    first = signature.groupBy(*alike).agg(F.min("term").alias("first"), F.count(F.lit(1)).alias("c"))
    suspects = signature.join(first.filter("c > 1"), alike).filter(F.col("term") != F.col("first"))
    pairs = suspects.select("proj_id", "term", "first", "size")
    shared = (
        m.join(pairs, ["proj_id", "term"])
        .join(m.select("proj_id", F.col("term").alias("first"), "node"), ["proj_id", "first", "node"], "left_semi")
        .groupBy("proj_id", "term", "size").agg(F.count(F.lit(1)).alias("common"))
        .filter(F.col("common") == F.col("size")).select("proj_id", "term")
    )
    return m.join(shared, ["proj_id", "term"], "left_anti")

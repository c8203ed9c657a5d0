"""Table upkeep the database did implicitly: ON DELETE CASCADE (R4) and
column defaults (R5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..session import ensure_checkpoint_dir

def _cascades_first() -> list[str]:
    """All tables, every parent of a cascading key before its children."""
    order: list[str] = []

    def place(table: str) -> None:
        for child, _col, parent, _pcol, cascade in schemas.FOREIGN_KEYS:
            if cascade and child == table and parent not in order:
                place(parent)
        if table not in order:
            order.append(table)

    for child, _col, parent, _pcol, _cascade in schemas.FOREIGN_KEYS:
        place(parent)
        place(child)
    return order


def _keys(cascade: bool, tables: dict[str, DataFrame], child: str | None = None):
    """Declared keys of one kind whose columns the tables have: (child, column, parent)."""
    for c, col, parent, _pcol, on_cascade in schemas.FOREIGN_KEYS:
        if (on_cascade == cascade and child in (None, c) and c in tables and parent in tables
                and col in tables[c].columns):
            yield c, col, parent


def _settle(ids: DataFrame) -> DataFrame:
    """Materialise an id set in the shared checkpoint folder: later semi / anti
    joins read it back instead of re-running the joins that produced it, and
    a lost executor does not send the job back to the start."""
    ensure_checkpoint_dir(ids.sparkSession)
    return ids.checkpoint(eager=True)


def _closure(tables: dict[str, DataFrame], roots: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Per table the rows that go with the roots, as (_id, _root_table, _root): the roots
    themselves and all that hangs on them through cascading keys."""
    doomed: dict[str, DataFrame] = {}
    for table in _cascades_first():
        if table not in tables:
            continue
        parts = []
        if table in roots:
            parts.append(roots[table].select("_id", F.lit(table).alias("_root_table"),
                                             F.col("_id").alias("_root")))
        if "id" in tables[table].columns:
            for _c, col, parent in _keys(True, tables, table):
                if parent in doomed:
                    rows = tables[table].select(F.col("id").alias("_child"), F.col(col).alias("_id"))
                    parts.append(rows.join(doomed[parent], "_id").select(
                        F.col("_child").alias("_id"), "_root_table", "_root"))
        if parts:
            found = parts[0]
            for part in parts[1:]:
                found = found.unionByName(part)
            doomed[table] = _settle(found.distinct())
    return doomed


def _remaining(tables: dict[str, DataFrame], doomed: dict[str, DataFrame], table: str) -> DataFrame:
    """Rows of a table outside the closure. A child without an id column goes by its keys."""
    df = tables[table]
    own = [("id", table)] if "id" in df.columns else []
    for col, of in own + [(col, parent) for _c, col, parent in _keys(True, tables, table)]:
        if of in doomed:
            df = df.join(doomed[of].select(F.col("_id").alias(col)).distinct(), col, "left_anti")
    return df.select(*tables[table].columns)


def cascade_delete(tables: dict[str, DataFrame],
                   requested: dict[str, DataFrame]) -> tuple[dict[str, DataFrame], DataFrame]:
    """Delete ``requested[table]`` ids (a one-column frame ``id``) and
    everything that cascades from them; return (remaining tables, blocked).

    All requests are one delete. A requested id is blocked if a row that stays
    refers, through a key without ON DELETE CASCADE, to the row itself or to one
    that would go with it; PostgreSQL refuses there. What a blocked id would have taken
    along stays too and may block others, so this repeats until nothing changes.
    Blocked ids are kept and returned as ``blocked(table_name, id)``. Any table
    may be requested. Ids that do not exist change nothing and are not reported.
    All steps are semi / anti joins, so no id list passes through the driver.
    """
    unknown = sorted(t for t in requested if t not in tables or "id" not in tables[t].columns)
    if unknown:
        raise ValueError(f"no table with ids to delete from: {', '.join(unknown)}")
    spark = next(iter(tables.values())).sparkSession
    roots = {t: _settle(tables[t].select(F.col("id").alias("_id")).distinct()
                        .join(ids.select(F.col("id").alias("_id")).distinct(), "_id", "left_semi"))
             for t, ids in requested.items()}
    blocked_all = spark.range(0).select(F.lit("").alias("table_name"), F.col("id"))
    while True:
        doomed = _closure(tables, roots)
        hits = None
        for child, col, parent in _keys(False, tables):
            if parent not in doomed:
                continue
            # Distinct first: a parent that a third of all child rows refer to is one row
            # per map task before the shuffle.
            refs = (_remaining(tables, doomed, child).filter(F.col(col).isNotNull())
                    .select(F.col(col).alias("_id")).distinct())
            hit = doomed[parent].join(refs, "_id", "left_semi").select("_root_table", "_root")
            hits = hit if hits is None else hits.unionByName(hit)
        if hits is None:
            break
        hits = _settle(hits.distinct())
        if hits.isEmpty():
            break
        blocked_all = blocked_all.unionByName(
            hits.select(F.col("_root_table").alias("table_name"), F.col("_root").alias("id")))
        roots = {t: _settle(ids.join(hits.filter(F.col("_root_table") == t)
                                     .select(F.col("_root").alias("_id")), "_id", "left_anti"))
                 for t, ids in roots.items()}
    return {t: _remaining(tables, doomed, t) for t in tables}, blocked_all


def delete_summary(before: dict[str, DataFrame], after: dict[str, DataFrame],
                   blocked: DataFrame) -> DataFrame:
    """Rows before / after per table and blocked parent ids, as one frame
    (a union of per-table counts folded by table name; no cross join)."""
    def counted(df: DataFrame, name: str, kind: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("table_name"), F.lit(kind).alias("kind"), "n")

    parts = []
    for name, df in before.items():
        parts.append(counted(df, name, "before"))
        parts.append(counted(after[name], name, "after"))
    parts.append(blocked.groupBy("table_name")
                 .agg(F.count(F.lit(1)).alias("n"))
                 .select("table_name", F.lit("blocked").alias("kind"), "n"))
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionByName(p)

    def pick(kind: str):
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0))

    folded = stacked.groupBy("table_name").agg(pick("before").alias("rows_before"),
                                               pick("after").alias("rows_after"),
                                               pick("blocked").alias("blocked_ids"))
    return folded.select("table_name", "rows_before", "rows_after",
                         (F.col("rows_before") - F.col("rows_after")).alias("rows_removed"),
                         "blocked_ids")


def with_defaults(df: DataFrame, table: str) -> DataFrame:
    """Add the DDL default for each declared column the input lacks. A
    column that is present keeps its values, explicit NULLs included."""
    out = df
    for col, literal, type_name in schemas.DEFAULTS.get(table, []):
        if col not in out.columns:
            out = out.withColumn(col, F.expr(literal).cast(type_name))
    return out

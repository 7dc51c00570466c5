"""Slowly changing history (SCD type 2) as functions from tables to tables.

A snapshot run compares the source with the open rows only; closed rows pass
through untouched. Matching is a left join from the source (a skewed key is
split at run time) and, only where missing keys matter, an anti join. Rows whose
key is null never match, so they skip the joins.
"""

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import names as N
from tidemark.functions.scalars import as_column

HARD_DELETE_MODES = ("ignore", "invalidate", "new_record")


@dataclass(frozen=True)
class HistoryRules:
    """How a history table is kept.

    ``check`` None selects the timestamp strategy on column ``updated_at``;
    otherwise the named columns (or ``"all"``) are compared. ``open_until``
    replaces null as the end of an open row. ``renamed`` maps default meta
    column names to other ones.
    """

    keys: tuple[str, ...]
    check: tuple[str, ...] | str | None = None
    updated_at: str | None = None
    hard_deletes: str = "ignore"
    open_until: str | None = None
    renamed: dict[str, str] = field(default_factory=dict)

    def __post_init__(self):
        if self.hard_deletes not in HARD_DELETE_MODES:
            raise ValueError(f"hard_deletes must be one of {HARD_DELETE_MODES}")
        if self.check is None and self.updated_at is None:
            raise ValueError("the timestamp strategy needs an updated_at column")
        if self.check is not None and not self.check:
            raise ValueError("check must be 'all' or a list of columns")

    def meta(self, name: str) -> str:
        return self.renamed.get(name, name)

    @property
    def tracks_deletes(self) -> bool:
        return self.hard_deletes != "ignore"

    @property
    def flags_deletes(self) -> bool:
        return self.hard_deletes == "new_record"


def scd_id(parts) -> Column:
    """MD5 of the parts as text joined by a bar, null as empty text."""
    texts = [F.coalesce(as_column(p).cast("string"), F.lit("")) for p in parts]
    return F.md5(F.concat_ws("|", *texts))


def _moment(as_of) -> Column:
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("timestamp_ntz")


def _open_until(rules: HistoryRules) -> Column:
    return F.lit(rules.open_until).cast("timestamp_ntz")


def _stamp(rules: HistoryRules, as_of) -> Column:
    return F.col(rules.updated_at) if rules.updated_at else _moment(as_of)


def is_open(rules: HistoryRules) -> Column:
    """Condition of rows that no later version or deletion has closed."""
    valid_to = F.col(rules.meta(N.VALID_TO))
    if rules.open_until is None:
        return valid_to.isNull()
    return valid_to.isNull() | (valid_to == _open_until(rules))


def _new_version(source: DataFrame, rules: HistoryRules, as_of) -> DataFrame:
    """Source rows with the meta columns of a fresh open row."""
    stamp = _stamp(rules, as_of)
    columns = {
        rules.meta(N.SCD_ID): scd_id([*rules.keys, stamp]),
        rules.meta(N.UPDATED_AT): stamp,
        rules.meta(N.VALID_FROM): stamp,
        rules.meta(N.VALID_TO): _open_until(rules),
    }
    if rules.flags_deletes:
        columns[rules.meta(N.IS_DELETED)] = F.lit("False")
    return source.withColumns(columns)


def initial_history(source: DataFrame, rules: HistoryRules, as_of) -> DataFrame:
    """First snapshot: every row open."""
    return _new_version(source, rules, as_of)


def check_changed(target_columns, source_columns, rules: HistoryRules, old, new) -> Column:
    """Changed if any compared column differs, nulls counted as values.

    ``old`` and ``new`` turn a column name into the column of that side. A
    compared column the history does not have yet marks every row changed.
    """
    compared = source_columns if rules.check == "all" else rules.check
    known = {c.lower() for c in target_columns}
    if any(c.lower() not in known for c in compared):
        return F.lit(True)
    changed = F.lit(False)
    for c in compared:
        changed = changed | ~old(c).eqNullSafe(new(c))
    return changed


def timestamp_changed(rules: HistoryRules, old_valid_from: Column, new_updated_at: Column) -> Column:
    return old_valid_from < new_updated_at


def stage_changes(target: DataFrame, source: DataFrame, rules: HistoryRules, as_of) -> DataFrame:
    """Change set of one snapshot run, tagged insert, update or delete.

    Inserts are new versions; an update or delete row carries the id of the open
    row to close and its end in the valid-to column.
    """
    source_columns = source.columns
    meta = {n: rules.meta(n) for n in (N.SCD_ID, N.UPDATED_AT, N.VALID_FROM, N.VALID_TO)}
    flag = rules.meta(N.IS_DELETED)
    out_columns = [N.CHANGE_TYPE, *source_columns, *meta.values()] + ([flag] if rules.flags_deletes else [])
    open_rows = target.filter(is_open(rules))

    fresh = _new_version(source, rules, as_of)
    has_key = F.lit(True)
    for k in rules.keys:
        has_key = has_key & F.col(k).isNotNull()

    # The open side of the join: keys, compared columns, and what closing needs.
    compared = source_columns if rules.check == "all" else (rules.check or ())
    lowered = {c.lower(): c for c in target.columns}
    needed = dict.fromkeys([*rules.keys, *[lowered[c.lower()] for c in compared if c.lower() in lowered]])
    needed.update(dict.fromkeys([meta[N.SCD_ID], meta[N.VALID_FROM]] + ([flag] if rules.flags_deletes else [])))
    old_names = {c.lower(): f"_old_{c.lower()}" for c in needed}
    old_side = open_rows.filter(has_key).select(*[F.col(c).alias(old_names[c.lower()]) for c in needed])

    def old(c):
        return F.col(old_names[c.lower()])

    same_key = F.lit(True)
    for k in rules.keys:
        same_key = same_key & (F.col(k) == old(k))
    matched = old(rules.keys[0]).isNotNull()
    if rules.check is None:
        changed = timestamp_changed(rules, old(meta[N.VALID_FROM]), F.col(rules.updated_at))
    else:
        changed = check_changed(target.columns, source_columns, rules, old, F.col)

    if rules.flags_deletes:  # a key that comes back is a new version, changed or not
        changed = changed | F.coalesce(old(flag) == "True", F.lit(False))

    joined = fresh.filter(has_key).join(old_side, same_key, "left")
    kinds = F.when(matched, F.array(F.lit("insert"), F.lit("update"))).otherwise(F.array(F.lit("insert")))
    moved = joined.filter(~matched | changed).withColumn(N.CHANGE_TYPE, F.explode(kinds))
    closing = F.col(N.CHANGE_TYPE) == "update"
    columns = {
        meta[N.VALID_TO]: F.when(closing, F.col(meta[N.UPDATED_AT])).otherwise(F.col(meta[N.VALID_TO])),
        meta[N.SCD_ID]: F.when(closing, old(meta[N.SCD_ID])).otherwise(F.col(meta[N.SCD_ID])),
    }
    if rules.flags_deletes:
        columns[flag] = F.when(closing, old(flag)).otherwise(F.col(flag))
    moved = moved.withColumns(columns)
    keyless = fresh.filter(~has_key).withColumn(N.CHANGE_TYPE, F.lit("insert"))
    changes = moved.select(*out_columns).unionByName(keyless.select(*out_columns))
    if not rules.tracks_deletes:
        return changes
    return changes.unionByName(_gone(open_rows, source, rules, as_of, out_columns, has_key))


def _gone(open_rows, source, rules, as_of, out_columns, has_key) -> DataFrame:
    """Open rows whose key left the source: the row to close and, if wanted, a deletion record."""
    now = _moment(as_of)
    present = source.filter(has_key).select(*[F.col(k).alias(f"_src_{k}") for k in rules.keys])
    same_key = F.lit(True)
    for k in rules.keys:
        same_key = same_key & (F.col(k) == F.col(f"_src_{k}"))
    if rules.flags_deletes and rules.meta(N.IS_DELETED) in open_rows.columns:
        # A key that is recorded as deleted already gets no further record.
        open_rows = open_rows.filter(~F.coalesce(F.col(rules.meta(N.IS_DELETED)) == "True", F.lit(False)))
    gone = open_rows.join(present, same_key, "left_anti")
    kinds = ["delete", "insert"] if rules.flags_deletes else ["delete"]
    gone = gone.withColumn(N.CHANGE_TYPE, F.explode(F.array(*[F.lit(k) for k in kinds])))
    closing = F.col(N.CHANGE_TYPE) == "delete"
    have = {c.lower() for c in open_rows.columns}
    valid_to, own_id = rules.meta(N.VALID_TO), rules.meta(N.SCD_ID)
    special = {
        N.CHANGE_TYPE: F.col(N.CHANGE_TYPE),
        rules.meta(N.UPDATED_AT): now,
        rules.meta(N.VALID_FROM): now,
        valid_to: F.when(closing, now).otherwise(F.col(valid_to)),
        own_id: F.when(closing, F.col(own_id)).otherwise(scd_id([own_id, now])),
    }
    if rules.flags_deletes:
        flag = rules.meta(N.IS_DELETED)
        special[flag] = F.when(closing, F.col(flag)).otherwise(F.lit("True"))

    def column(c):
        if c in special:
            return special[c].alias(c)
        kind = source.schema[c].dataType
        kept = F.when(~closing, F.col(c)) if c.lower() in have else F.lit(None)
        return kept.cast(kind).alias(c)

    return gone.select(*[column(c) for c in out_columns])


def merge_changes(target: DataFrame, changes: DataFrame, rules: HistoryRules) -> DataFrame:
    """History after a change set: matched open rows closed, new versions added.

    Only open rows meet the change set. Columns new in the source are added.
    """
    own_id, valid_to = rules.meta(N.SCD_ID), rules.meta(N.VALID_TO)
    closing = (
        changes.filter(F.col(N.CHANGE_TYPE) != "insert")
        .groupBy(F.col(own_id).alias("_close_id"))
        .agg(F.min(valid_to).alias("_close_at"))
    )
    closed = target.filter(~is_open(rules))
    still_open = (
        target.filter(is_open(rules))
        .join(closing, F.col(own_id) == F.col("_close_id"), "left")
        .withColumn(valid_to, F.coalesce("_close_at", valid_to))
        .select(*target.columns)
    )
    added = changes.filter(F.col(N.CHANGE_TYPE) == "insert").drop(N.CHANGE_TYPE)
    return closed.unionByName(still_open).unionByName(added, allowMissingColumns=True)


def snapshot(target: DataFrame | None, source: DataFrame, rules: HistoryRules, as_of, stage=None) -> DataFrame:
    """One snapshot run. ``as_of`` is the time of the run.

    The change set is read twice by the merge; ``stage`` may write it to a table
    and hand that back, which a job on large tables should do.
    """
    if target is None:
        return initial_history(source, rules, as_of)
    changes = stage_changes(target, source, rules, as_of)
    return merge_changes(target, stage(changes) if stage else changes, rules)
